"""External assertion archives in XML: representations, assertions, conditions."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from varloom.functions.evidence import lenient_date, record_status
from varloom.functions.ids import stable_id

ROOTS = ("ReleaseSet", "ClinVarVariationRelease")

# The element paths that are read.
_XREF = "array<struct<_DB:string,_Source:string,_ID:string>>"
_CLASS = (
    "array<struct<_DateLastEvaluated:string,_VALUE:string,Description:array<string>,"
    "Classification:array<string>,ReviewStatus:array<string>,SubmissionName:array<string>>>"
)
_CLASSES = (
    f"GermlineClassification:{_CLASS},ClinicalSignificance:{_CLASS},"
    f"SomaticClinicalImpact:{_CLASS},OncogenicityClassification:{_CLASS}"
)
_LOCATION = (
    "array<struct<SequenceLocation:array<struct<_Assembly:string,_Chr:string,_positionVCF:string,"
    "_start:string,_referenceAlleleVCF:string,_alternateAlleleVCF:string>>>>"
)
_ALLELE = f"_AlleleID:string,_VariationID:string,Location:{_LOCATION}"
_SIMPLE = f"array<struct<{_ALLELE}>>"
_TRAITS = (
    f"array<struct<Trait:array<struct<Name:array<struct<_VALUE:string,ElementValue:array<string>>>,XRef:{_XREF}>>,"
    f"Condition:array<struct<Name:array<struct<_VALUE:string,ElementValue:array<string>>>,XRef:{_XREF}>>>>"
)
_ASSERTION = (
    "array<struct<_Accession:string,_Version:string,_RecordStatus:string,RecordStatus:array<string>,"
    "ClinVarAccession:array<struct<_Acc:string,_Accession:string,_Version:string>>,"
    "Submitter:array<struct<_Name:string,_SubmitterName:string,_ID:string,_SubmitterID:string>>,"
    f"{_CLASSES},Description:array<string>,ReviewStatus:array<string>,TraitSet:{_TRAITS},"
    "ObservedIn:array<string>,Evidence:array<string>,"
    f"Method:array<struct<_VALUE:string,MethodType:array<string>>>,XRef:{_XREF}>>"
)
_RECORD = (
    f"struct<SimpleAllele:{_SIMPLE},"
    f"Haplotype:array<struct<{_ALLELE},SimpleAllele:{_SIMPLE}>>,"
    f"Genotype:array<struct<{_ALLELE},SimpleAllele:{_SIMPLE},"
    f"Haplotype:array<struct<{_ALLELE},SimpleAllele:{_SIMPLE}>>>>,"
    f"Classifications:struct<{_CLASSES},Description:array<string>>,Description:array<string>,"
    f"ClinicalAssertion:{_ASSERTION},ClinicalAssertionList:struct<ClinicalAssertion:{_ASSERTION}>>"
)
ARCHIVE_SCHEMA = (
    "_Accession string, _Version string, _VariationID string, _RecordStatus string, "
    "RecordStatus array<string>, "
    f"ClassifiedRecord {_RECORD}, IncludedRecord {_RECORD}"
)
_TYPES = (
    ("GermlineClassification", "germline"),
    ("ClinicalSignificance", "germline"),
    ("SomaticClinicalImpact", "somatic_clinical_impact"),
    ("OncogenicityClassification", "oncogenicity"),
)


def release_header(spark: SparkSession, paths, override: str | None = None) -> DataFrame:
    """Release identity and date from the root element, with a violation code."""
    lines = spark.read.text(paths)
    tag = "<(" + "|".join(ROOTS) + r")([\s>].*)"
    roots = lines.select(
        F.regexp_extract("value", tag, 1).alias("root"),
        F.regexp_extract("value", tag, 2).alias("attributes"),
    ).where("root <> ''")

    def attribute(*names):
        found = [
            F.nullif(F.regexp_extract("attributes", rf'[\s:]{n}="([^"]*)"', 1), F.lit(""))
            for n in names
        ]
        return F.coalesce(*found)

    closed = lines.where(F.col("value").rlike("</(" + "|".join(ROOTS) + r")\s*>")).agg(
        F.count(F.lit(1)).alias("closed")
    )
    first = roots.select(
        "root",
        attribute("Dated", "ReleaseDate", "releaseDate").alias("raw_date"),
        attribute("ReleaseID", "Release").alias("declared"),
        attribute("schemaLocation", "SchemaVersion").alias("schema_identity"),
    ).agg(F.count(F.lit(1)).alias("roots"), F.min(F.struct("root", "raw_date", "declared", "schema_identity")).alias("r"))
    identity = F.coalesce("r.declared", F.lit(override), "r.raw_date")
    date = lenient_date(F.col("r.raw_date"))
    violation = (
        F.when(F.col("roots") == 0, "unsupported_root")
        .when(
            F.lit(override).isNotNull()
            & F.col("r.declared").isNotNull()
            & (F.col("r.declared") != F.lit(override)),
            "override_contradicts_release",
        )
        .when(identity.isNull() | date.isNull(), "release_identity_or_date_absent")
        .when(closed.scalar() < F.col("roots"), "truncated_document")
    )
    return first.select(
        F.col("r.root").alias("xml_format"),
        identity.alias("release_identity"),
        date.alias("release_date"),
        F.col("r.schema_identity").alias("xml_schema_identity"),
        stable_id("snapshot", identity, date).alias("snapshot_id"),
        violation.alias("violation"),
    )


def scan_archives(spark: SparkSession, paths, snapshot_id: str) -> DataFrame:
    """One row per archive.

    Files are read as text records that end at the archive's closing tag, so one
    large plain file is split over many tasks (.gz files are one task each); each
    record is then parsed on its own.
    """
    close = "</VariationArchive>"
    # NULL (never parsed) for the text around the archives, whatever order filters run in.
    start = F.regexp_extract("value", r"(?s)(<VariationArchive[\s>].*)$", 1)
    body = F.when(start != "", F.concat(start, F.lit(close)))
    rows = (
        spark.read.text(paths, lineSep=close)
        # a filter on the parsed archive would parse it a second time
        .where(body.isNotNull())
        .select(F.from_xml(body, ARCHIVE_SCHEMA, {"mode": "FAILFAST"}).alias("archive"))
        .select("archive.*")
    )
    record = F.coalesce("ClassifiedRecord", "IncludedRecord")
    return rows.withColumns(
        {
            "record": record,
            "snapshot_id": F.lit(snapshot_id),
            "vcv_accession": F.coalesce("_Accession", F.lit("")),
            "vcv_version": F.coalesce("_Version", F.lit("1")).try_cast("int"),
        }
    )


def archive_violations(archives: DataFrame) -> DataFrame:
    return archives.where(
        "not startswith(vcv_accession, 'VCV') or vcv_version is null"
    ).select("vcv_accession", F.lit("invalid_archive_accession").alias("rule"))


def _first(array: Column) -> Column:
    return F.get(array, F.lit(0))


def _shape(archives: DataFrame) -> DataFrame:
    """Variation type, ids and location of the archive's first described allele."""
    simple = _first(F.col("record.SimpleAllele"))
    haplotype = _first(F.col("record.Haplotype"))
    genotype = _first(F.col("record.Genotype"))
    kind = (
        F.when(simple.isNotNull(), "SimpleAllele")
        .when(haplotype.isNotNull(), "Haplotype")
        .when(genotype.isNotNull(), "Genotype")
        .otherwise("unknown")
    )

    def located(allele):
        return _first(_first(allele["Location"])["SequenceLocation"])

    inner = _first(haplotype["SimpleAllele"])
    deep = F.coalesce(
        located(genotype),
        located(_first(genotype["SimpleAllele"])),
        located(_first(genotype["Haplotype"])),
        located(_first(_first(genotype["Haplotype"])["SimpleAllele"])),
    )
    where = F.coalesce(located(simple), located(haplotype), located(inner), deep)
    return archives.withColumns(
        {
            "variation_type": kind,
            "loc": where,
            "described_id": F.coalesce(
                simple["_VariationID"], haplotype["_VariationID"], genotype["_VariationID"]
            ),
            "described_allele": F.coalesce(
                simple["_AlleleID"], haplotype["_AlleleID"], genotype["_AlleleID"]
            ),
        }
    )


def _digits(value: Column) -> Column:
    return F.when(value.rlike("^[0-9]+$"), value.try_cast("bigint"))


def representations(archives: DataFrame) -> DataFrame:
    rows = _shape(archives).select(
        "*",
        F.col("loc._Assembly").alias("assembly"),
        F.col("loc._Chr").alias("chromosome"),
        _digits(F.coalesce(F.nullif(F.trim("loc._positionVCF"), F.lit("")), F.col("loc._start"))).alias("position"),
        F.col("loc._referenceAlleleVCF").alias("reference"),
        F.col("loc._alternateAlleleVCF").alias("alternate"),
    )
    return rows.withColumn("representation_id", _representation_id()).select(
        "representation_id",
        "snapshot_id",
        "vcv_accession",
        "vcv_version",
        _digits(F.coalesce("_VariationID", "described_id")).alias("variation_id"),
        _digits(F.col("described_allele")).alias("allele_id"),
        "variation_type",
        "assembly",
        "chromosome",
        "position",
        "reference",
        "alternate",
        F.lit(None).cast("string").alias("source_rsid"),
    )


def _representation_id() -> Column:
    return stable_id("extvar", "snapshot_id", "vcv_accession", "vcv_version")


def _cleaned(texts: Column) -> Column:
    trimmed = F.transform(F.coalesce(texts, F.array().cast("array<string>")), lambda t: F.trim(t))
    return F.filter(trimmed, lambda t: t != "")


def _classified(holder: Column) -> Column:
    """All classification elements of a holder, tagged with element name and type."""
    def tagged(element, kind):
        return F.transform(
            F.coalesce(holder[element], F.array().cast(_CLASS)),
            lambda c: F.struct(
                F.lit(element).alias("element"),
                F.lit(kind).alias("type"),
                c["_DateLastEvaluated"].alias("dated"),
                F.array_distinct(
                    F.concat(_cleaned(c["Description"]), _cleaned(c["Classification"]))
                ).alias("terms"),
                _first(_cleaned(c["ReviewStatus"])).alias("review"),
                (F.size(_cleaned(c["SubmissionName"])) > 0).alias("criteria"),
            ),
        )

    return F.concat(*[tagged(element, kind) for element, kind in _TYPES])


def _fallback(element: str, terms: Column, review: Column) -> Column:
    return F.array(
        F.struct(
            F.lit(element).alias("element"),
            F.lit("unknown").alias("type"),
            F.lit(None).cast("string").alias("dated"),
            F.array_distinct(_cleaned(terms)).alias("terms"),
            review.alias("review"),
            F.lit(False).alias("criteria"),
        )
    )


def _or_unknown(found: Column, element: str, terms: Column, review: Column) -> Column:
    return F.when(F.size(found) > 0, found).otherwise(_fallback(element, terms, review))


def _submissions(archives: DataFrame) -> DataFrame:
    """One row per submitted record of each archive."""
    listed = F.concat(
        F.coalesce("record.ClinicalAssertion", F.array().cast(_ASSERTION)),
        F.coalesce("record.ClinicalAssertionList.ClinicalAssertion", F.array().cast(_ASSERTION)),
    )
    rows = archives.select(
        "snapshot_id", "vcv_accession", _representation_id().alias("representation_id"),
        F.explode(listed).alias("ca"),
    )
    node = _first(F.col("ca.ClinVarAccession"))
    return rows.withColumns(
        {
            "accession": F.coalesce("ca._Accession", node["_Acc"], F.lit("")),
            "version": F.coalesce("ca._Version", node["_Version"], F.lit("1")).try_cast("int"),
        }
    ).where(F.col("accession").startswith("SCV"))


def _traits(holder: Column) -> Column:
    return F.flatten(
        F.transform(
            F.coalesce(holder, F.array().cast(_TRAITS)),
            lambda s: F.concat(
                F.coalesce(s["Trait"], s["Condition"]),
                F.when(s["Trait"].isNotNull() & s["Condition"].isNotNull(), s["Condition"]).otherwise(
                    F.slice(F.coalesce(s["Trait"], s["Condition"]), 1, 0)
                ),
            ),
        )
    )


def _citations(submission: Column) -> Column:
    refs = F.concat(
        F.coalesce(submission["XRef"], F.array().cast(_XREF)),
        F.flatten(
            F.transform(
                F.coalesce(_traits(submission["TraitSet"]), F.array()),
                lambda t: F.coalesce(t["XRef"], F.array().cast(_XREF)),
            )
        ),
    )
    return F.transform(
        F.filter(refs, lambda r: r["_ID"].isNotNull()),
        lambda r: F.concat(F.coalesce(r["_Source"], r["_DB"], F.lit("unknown")), F.lit(":"), r["_ID"]),
    )


def _shaped(rows: DataFrame, level: str) -> DataFrame:
    c = F.col("c")
    fingerprint = F.sha2(
        F.to_json(
            F.struct(
                "accession", "version", c["type"].alias("type"), c["terms"].alias("terms"),
                c["review"].alias("review"), "status_term", "submitter_name",
                "submitter_identifier", c["dated"].alias("dated"), "method", "citations",
                "observed_in_count",
            )
        ),
        256,
    )
    return rows.withColumn("record_fingerprint", fingerprint).select(
        stable_id(
            "assertion", "snapshot_id", "accession", "version", "record_fingerprint", c["type"]
        ).alias("assertion_id"),
        F.concat_ws(".", "accession", "version").alias("logical_source_key"),
        "snapshot_id",
        "representation_id",
        F.col("accession").alias("source_accession"),
        F.col("version").alias("accession_version"),
        "vcv_accession",
        F.lit(level).alias("assertion_level"),
        c["type"].alias("classification_type"),
        c["element"].alias("classification_element"),
        c["criteria"].alias("criteria_provided"),
        c["terms"].alias("source_classification_terms"),
        c["review"].alias("review_status"),
        record_status(F.col("status_term")).alias("record_status"),
        "status_term",
        "submitter_name",
        "submitter_identifier",
        lenient_date(c["dated"]).alias("date_last_evaluated"),
        F.col("method").alias("assertion_method"),
        F.array_sort(F.array_distinct("citations")).alias("citation_identifiers"),
        "observed_in_count",
        "source_evidence_structure_count",
        "record_fingerprint",
    )


def _size(array: Column) -> Column:
    return F.coalesce(F.size(array), F.lit(0)) * F.when(array.isNull(), 0).otherwise(1)


def submitted_assertions(archives: DataFrame) -> DataFrame:
    ca = F.col("ca")
    who = _first(ca["Submitter"])
    method = _first(ca["Method"])
    rows = _submissions(archives).select(
        "*",
        F.explode(
            _or_unknown(
                _classified(ca), "ClinicalAssertion", ca["Description"], _first(_cleaned(ca["ReviewStatus"]))
            )
        ).alias("c"),
        F.coalesce(ca["_RecordStatus"], _first(_cleaned(ca["RecordStatus"]))).alias("status_term"),
        F.coalesce(who["_Name"], who["_SubmitterName"]).alias("submitter_name"),
        F.coalesce(who["_ID"], who["_SubmitterID"]).alias("submitter_identifier"),
        F.coalesce(_first(_cleaned(method["MethodType"])), F.trim(method["_VALUE"])).alias("method"),
        _citations(ca).alias("citations"),
        _size(ca["ObservedIn"]).alias("observed_in_count"),
        (_size(ca["ObservedIn"]) + _size(ca["Evidence"])).alias("source_evidence_structure_count"),
    )
    return _shaped(rows, "source_submitted")


def aggregate_assertions(archives: DataFrame) -> DataFrame:
    """Source-computed classifications outside submissions, else one of unknown type."""
    held = F.col("record.Classifications")
    direct = F.coalesce(_classified(held), F.array().cast(_classified_type()))
    nested = F.concat(
        F.coalesce("record.ClinicalAssertion", F.array().cast(_ASSERTION)),
        F.coalesce("record.ClinicalAssertionList.ClinicalAssertion", F.array().cast(_ASSERTION)),
    )
    terms = F.coalesce(F.col("record.Classifications.Description"), F.col("record.Description"))
    rows = archives.withColumn("nested", nested).select(
        "snapshot_id",
        "vcv_accession",
        _representation_id().alias("representation_id"),
        F.col("vcv_accession").alias("accession"),
        F.col("vcv_version").alias("version"),
        F.explode(
            _or_unknown(direct, "Classifications", terms, F.lit(None).cast("string"))
        ).alias("c"),
        F.coalesce("_RecordStatus", _first(_cleaned(F.col("RecordStatus")))).alias("status_term"),
        F.lit(None).cast("string").alias("submitter_name"),
        F.lit(None).cast("string").alias("submitter_identifier"),
        _first(
            F.filter(
                F.transform(
                    "nested",
                    lambda a: F.coalesce(
                        _first(_cleaned(_first(a["Method"])["MethodType"])), F.trim(_first(a["Method"])["_VALUE"])
                    ),
                ),
                lambda m: m.isNotNull() & (m != ""),
            )
        ).alias("method"),
        F.flatten(F.transform("nested", _citations)).alias("citations"),
        F.aggregate("nested", F.lit(0), lambda n, a: n + _size(a["ObservedIn"])).alias(
            "observed_in_count"
        ),
        F.aggregate(
            "nested", F.lit(0), lambda n, a: n + _size(a["ObservedIn"]) + _size(a["Evidence"])
        ).alias("source_evidence_structure_count"),
    )
    return _shaped(rows, "source_computed_aggregate")


def _classified_type() -> str:
    return (
        "array<struct<element:string,type:string,dated:string,terms:array<string>,review:string,"
        "criteria:boolean>>"
    )


def assertions(archives: DataFrame) -> DataFrame:
    return aggregate_assertions(archives).unionByName(submitted_assertions(archives))


def relationships(assertion_rows: DataFrame) -> DataFrame:
    """Submitted × aggregate assertions of one archive (``contributes_to_aggregate``)."""
    side = assertion_rows.select("representation_id", "assertion_id", "assertion_level", "snapshot_id")
    submitted = side.where("assertion_level = 'source_submitted'").select(
        "representation_id", "snapshot_id", F.col("assertion_id").alias("subject_assertion_id")
    )
    aggregate = side.where("assertion_level = 'source_computed_aggregate'").select(
        "representation_id", F.col("assertion_id").alias("object_assertion_id")
    )
    return submitted.join(aggregate, "representation_id").select(
        stable_id("arel", "subject_assertion_id", "object_assertion_id").alias("relationship_id"),
        "snapshot_id",
        "subject_assertion_id",
        F.lit("contributes_to_aggregate").alias("predicate"),
        "object_assertion_id",
    )


def condition_rows(archives: DataFrame) -> DataFrame:
    """Named traits per submission: accession, version, condition fields."""
    rows = _submissions(archives).select(
        "snapshot_id", "representation_id", "accession", "version",
        F.explode(_traits(F.col("ca.TraitSet"))).alias("t"),
    )
    names = F.flatten(
        F.transform(
            F.coalesce("t.Name", F.array().cast("array<struct<_VALUE:string,ElementValue:array<string>>>")),
            lambda n: F.when(
                F.size(_cleaned(n["ElementValue"])) > 0, _cleaned(n["ElementValue"])
            ).otherwise(_cleaned(F.array(n["_VALUE"]))),
        )
    )
    ref = _first(F.col("t.XRef"))
    return (
        rows.select(
            "snapshot_id", "representation_id", "accession", "version",
            F.get(names, F.lit(0)).alias("source_name"),
            ref["_ID"].alias("source_identifier"),
            ref["_DB"].alias("source_identifier_type"),
        )
        .where("source_name is not null")
        .withColumn(
            "condition_id",
            stable_id(
                "condition", "snapshot_id", "source_identifier_type", "source_identifier", "source_name"
            ),
        )
    )


def conditions(rows: DataFrame) -> DataFrame:
    return rows.select(
        "condition_id", "snapshot_id", "source_identifier", "source_identifier_type", "source_name"
    ).distinct()


def condition_links(rows: DataFrame, assertion_rows: DataFrame) -> DataFrame:
    """(assertion, condition) links; a trait repeated in one submission links once."""
    subject = assertion_rows.where("assertion_level = 'source_submitted'").select(
        "representation_id",
        F.col("source_accession").alias("accession"),
        F.col("accession_version").alias("version"),
        "assertion_id",
    )
    return (
        rows.select("representation_id", "accession", "version", "condition_id")
        .join(subject, ["representation_id", "accession", "version"])
        .select("assertion_id", "condition_id")
        .distinct()
        # made from both ids, so it is no part of what makes a link distinct
        .select(stable_id("acrel", "assertion_id", "condition_id").alias("relationship_id"), "assertion_id", "condition_id")
    )
