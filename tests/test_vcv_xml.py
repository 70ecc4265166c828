import gzip

from varloom.operators.links import exact_allele_links
from varloom.sources import vcv_xml as vx


def node(name, *inside, **attributes):
    """An element as text; inside may be text or other elements."""
    shown = "".join(f' {k}="{v}"' for k, v in attributes.items())
    return f"<{name}{shown}>{''.join(inside)}</{name}>" if inside else f"<{name}{shown}/>"


def place(build, chrom, ref=None, alt=None, vcf=None, start=None):
    given = {"Assembly": build, "Chr": chrom, "positionVCF": vcf, "start": start, "referenceAlleleVCF": ref, "alternateAlleleVCF": alt}
    return node("SequenceLocation", **{k: v for k, v in given.items() if v is not None})


def allele(*places, ids=None):
    return node("SimpleAllele", *([node("Location", *places)] if places else []), **(ids or {}))


def judged(kind, term, review=None, dated=None):
    return node(
        kind, node("Description", term), *([node("ReviewStatus", review)] if review else []),
        **({"DateLastEvaluated": dated} if dated else {}),
    )


def trait(name, *codes):
    return node("Trait", node("Name", node("ElementValue", name)), *[node("XRef", DB=d, ID=i) for d, i in codes])


def submission(accession, version, *inside, **attributes):
    return node("ClinicalAssertion", *inside, Accession=accession, Version=version, **attributes)


def archive(number, *inside, record="ClassifiedRecord"):
    return node("VariationArchive", node(record, *inside), Accession=f"VCV{number:09d}", Version="4", VariationID=number)


# Own cases: an empty positionVCF beside a start, two places, a genotype of haplotypes, an included record,
# aggregates of two kinds, a repeated trait, a list of submissions, a foreign accession.
SUBMITTED = [
    submission(
        "SCV000000011", "2",
        node("ClinVarAccession", Acc="SCV000000011", Version="2"), node("Submitter", Name="North", ID="n1"),
        judged("GermlineClassification", "term one", "one submitter", "2024-02-29T12:30"),
        node("TraitSet", trait("blue", ("DBX", "7")), trait("blue", ("DBX", "7")), trait("green")),
        node("ObservedIn"), node("ObservedIn"), node("Method", node("MethodType", "reading")),
        RecordStatus="current",
    ),
    node(
        "ClinicalAssertionList",
        submission("SCV000000012", "5", node("Submitter", SubmitterName="South", SubmitterID="s9"), judged("GermlineClassification", "term two", dated="last week"), RecordStatus="replaced by another"),
        submission("SCV000000013", "1", judged("OncogenicityClassification", "term three")),
        submission("XYZ1", "1"),
    ),
]
ARCHIVES = [
    archive(
        501,
        allele(place("GRCh38", "7", "C", "T", vcf="", start="4400"), place("GRCh37", "7", "C", "T", vcf="4300"), ids={"AlleleID": "61", "VariationID": "501"}),
        node("Classifications", judged("GermlineClassification", "whole term", "many", "2023-01-15"), judged("OncogenicityClassification", "other term")),
        *SUBMITTED,
    ),
    archive(502, node("Genotype", node("Haplotype", allele(place("GRCh38", "X", "G", "A", vcf="88"))), node("Haplotype", allele()))),
    archive(503, node("Haplotype", allele(ids={"AlleleID": "63"}))),
    archive(504, allele(), record="IncludedRecord"),
]
DOCUMENT = '<?xml version="1.0"?>\n' + node("ReleaseSet", "\n", *[a + "\n" for a in ARCHIVES], Dated="2025-11-30", ReleaseID="own-11", SchemaVersion="s2") + "\n"


def archives(spark, write, name="a.xml"):
    content = DOCUMENT if name.endswith("xml") else gzip.compress(DOCUMENT.encode())
    path = write(name, content)
    head = vx.release_header(spark, path).first()
    return path, head, vx.scan_archives(spark, path, head["snapshot_id"])


def test_header(spark, write):
    path, head, _ = archives(spark, write)
    assert (head["release_identity"], str(head["release_date"]), head["xml_format"]) == (
        "own-11",
        "2025-11-30",
        "ReleaseSet",
    )
    assert head["violation"] is None and head["xml_schema_identity"] == "s2"
    other = vx.release_header(spark, path, "different").first()
    assert other["violation"] == "override_contradicts_release"
    nothing = vx.release_header(spark, write("n.xml", "<Other/>\n")).first()
    assert nothing["violation"] == "unsupported_root"
    cut_off = vx.release_header(spark, write("t.xml", DOCUMENT[: DOCUMENT.rindex("</ReleaseSet>")])).first()
    assert cut_off["violation"] == "truncated_document"


def test_one_file_is_read_in_parallel(spark, write):
    body = "".join(
        f'<VariationArchive Accession="VCV{i:09d}" Version="1" VariationID="{i}">\n<ClassifiedRecord>'
        f"<SimpleAllele/></ClassifiedRecord></VariationArchive>\n"
        for i in range(2000)
    )
    path = write("big.xml", f'<ReleaseSet Dated="2026-01-01">\n{body}</ReleaseSet>\n')
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        arc = vx.scan_archives(spark, path, "s")
        assert arc.rdd.getNumPartitions() > 4
        assert arc.select("vcv_accession").distinct().count() == 2000 == arc.count()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_representations_plain_and_gz(spark, write):
    for name in ("a.xml", "b.xml.gz"):
        _, _, arc = archives(spark, write, name)
        got = {r["vcv_accession"]: r for r in vx.representations(arc).collect()}
        assert len(got) == len(ARCHIVES)
        one = got["VCV000000501"]
        assert (one["variation_type"], one["assembly"], one["chromosome"], one["position"]) == ("SimpleAllele", "GRCh38", "7", 4400)
        assert (one["reference"], one["alternate"], one["variation_id"], one["allele_id"]) == ("C", "T", 501, 61)
        two = got["VCV000000502"]
        assert (two["variation_type"], two["chromosome"], two["position"]) == ("Genotype", "X", 88)
        assert got["VCV000000503"]["variation_type"] == "Haplotype" and got["VCV000000503"]["position"] is None
        assert got["VCV000000504"]["position"] is None
        assert vx.archive_violations(arc).count() == 0


def test_assertions(spark, write):
    _, _, arc = archives(spark, write)
    found = vx.assertions(arc).collect()
    submitted = {r["source_accession"]: r for r in found if r["assertion_level"] == "source_submitted"}
    whole = [r for r in found if r["assertion_level"] == "source_computed_aggregate"]
    assert sorted(submitted) == ["SCV000000011", "SCV000000012", "SCV000000013"]
    kinds = {(r["source_accession"], r["classification_type"]): list(r["source_classification_terms"]) for r in whole}
    assert kinds[("VCV000000501", "germline")] == ["whole term"]
    assert kinds[("VCV000000501", "oncogenicity")] == ["other term"]
    assert kinds[("VCV000000502", "unknown")] == kinds[("VCV000000503", "unknown")] == []
    one, two, three = (submitted[k] for k in sorted(submitted))
    assert (one["record_status"], str(one["date_last_evaluated"]), one["submitter_name"]) == ("current", "2024-02-29", "North")
    assert (one["observed_in_count"], one["assertion_method"], one["citation_identifiers"]) == (2, "reading", ["DBX:7"])
    assert (two["record_status"], two["date_last_evaluated"], two["accession_version"], two["submitter_identifier"]) == ("replaced", None, 5, "s9")
    assert three["classification_type"] == "oncogenicity"
    assert len({r["assertion_id"] for r in found}) == len(found)


def test_relationships_and_conditions(spark, write):
    _, _, arc = archives(spark, write)
    assertions = vx.assertions(arc)
    assert vx.relationships(assertions).count() == 3 * 2  # each submission with each aggregate of its archive
    conditions = vx.condition_rows(arc)
    assert vx.conditions(conditions).count() == 2
    assert vx.condition_links(conditions, assertions).count() == 2


def test_links(spark, write):
    _, _, arc = archives(spark, write)
    variants = spark.createDataFrame(
        [("v1", "GRCh38", "7", 4400, "C", "T")],
        "variant_id string, assembly string, chromosome string, position bigint, reference string, alternate string",
    )
    found = exact_allele_links(vx.representations(arc), variants).collect()
    assert [r["variant_id"] for r in found if r["reason"] == "exact_allele_match"] == ["v1"]
    assert {r["reason"] for r in found} == {"exact_allele_match", "unsupported_variation_type", "incomplete_allele_identity"}
