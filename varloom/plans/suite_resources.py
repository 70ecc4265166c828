"""Registered lookup and constraint-check queries and their SQL counterparts."""

import uuid

from pyspark.sql import functions as F

from varloom.operators import checks as ck, links as lk, lookup as lu, normalize as nz, projection as pj
from varloom.operators.materialize import checkpoint_root
from varloom.plans import suite_normalize, suite_structure
from varloom.plans.driver_views import ctes, table, view
from varloom.sources import bundles


def _source(spark, sf_dir):
    return lu.parsed_extract(view(spark, sf_dir, "bed_rows"))


def _tracks(spark, sf_dir):
    rows = _source(spark, sf_dir)
    return [(t, rows.where(F.col("track") == t).drop("track")) for t in ("common", "clinvar")]


def _markers(spark, sf_dir):
    return view(spark, sf_dir, "source_markers").drop("p")


def _tier_rows(spark, sf_dir):
    tracks = _tracks(spark, sf_dir)
    tiers = lu.tiered_lookup(_markers(spark, sf_dir), tracks)
    return lu.merged_extracts(lu.tier_records(tiers, tracks))


def _placed(spark, sf_dir):
    return lu.placements(_markers(spark, sf_dir), _tier_rows(spark, sf_dir))


def _accepted(spark, sf_dir):
    return lu.accepted_source(_placed(spark, sf_dir))


def extract_rows(spark, sf_dir):
    return _source(spark, sf_dir).withColumn("alternates", F.array_join("alternates", ","))


def merged_extracts(spark, sf_dir):
    rows = [r for _, r in _tracks(spark, sf_dir)]
    return lu.merged_extracts(*rows).withColumn("alternates", F.array_join("alternates", ","))


def two_tier_lookup(spark, sf_dir):
    return lu.tiered_lookup(_markers(spark, sf_dir), _tracks(spark, sf_dir))


def coverage_partition(spark, sf_dir):
    """Coverage flags derived from the lookup, with inconsistent flags for some markers."""
    tiers = two_tier_lookup(spark, sf_dir)
    number = F.regexp_extract("marker_id", "([0-9]+)", 1).cast("bigint")
    returned = F.col("tier") != "unresolved"
    flags = tiers.select(
        "marker_id",
        F.lit(True).alias("requested"),
        ((number % 17 != 4) & (number % 19 != 5)).alias("covered"),
        (returned & (number % 17 != 4)).alias("returned"),
        (~returned & (number % 17 != 4)).alias("missing"),
        (number % 17 == 4).alias("indeterminate"),
    )
    return lu.coverage_partition_violations(flags)


def marker_resources(spark, sf_dir):
    return lu.definitions(_accepted(spark, sf_dir), "GRCh37")


def cross_build_map(spark, sf_dir):
    target = lu.parsed_extract(view(spark, sf_dir, "target_rows"))
    return lu.cross_build_map(_accepted(spark, sf_dir), target)


def ambiguous_markers(spark, sf_dir):
    return lu.ambiguous_markers(_placed(spark, sf_dir))


def unresolved_markers(spark, sf_dir):
    return lu.unresolved_markers(
        _markers(spark, sf_dir), _tier_rows(spark, sf_dir), _placed(spark, sf_dir)
    )


def resource_statistics(spark, sf_dir):
    out = lu.resource_statistics(
        _markers(spark, sf_dir),
        _placed(spark, sf_dir),
        lu.parsed_extract(view(spark, sf_dir, "target_rows")),
        "GRCh37",
    )
    return out.withColumn("value", F.round("value", 6))


def fk_violations(spark, sf_dir):
    def v(name):
        return view(spark, sf_dir, name)

    groups = v("pca_scores").select("reference_group_id").where("reference_group_id <> 'g3'").distinct()
    return ck.union(
        ck.missing_parents(v("genotypes"), "variant_id", v("variants"), "variant_id", "genotype_variant"),
        ck.missing_parents(
            v("assertions"), "representation_id",
            v("representations").where("variation_type = 'SimpleAllele'"), "representation_id",
            "assertion_representation",
        ),
        ck.missing_parents(
            v("pgx_constraints"), "allele_id", v("pgx_alleles").where("status = 'active'"), "allele_id",
            "constraint_allele",
        ),
        ck.missing_parents(v("pca_scores"), "reference_group_id", groups, "reference_group_id", "score_group"),
        ck.missing_parents(v("calls"), "sample_id", v("members").where("s % 23 <> 5"), "subject_id", "call_subject"),
    )


def uniqueness_violations(spark, sf_dir):
    return ck.union(
        ck.repeated_keys(view(spark, sf_dir, "variants"), nz.KEY, "variant_key"),
        ck.repeated_keys(view(spark, sf_dir, "marker_defs"), ["marker_id"], "marker_id"),
        ck.repeated_keys(
            view(spark, sf_dir, "calls"), ["sample_id", "source_marker_id"], "sample_marker"
        ),
    )


def count_mismatches(spark, sf_dir):
    """Declared variant counts of score models against their prepared rows."""
    declared = view(spark, sf_dir, "pgs_models").select(
        "pgs_id", F.col("declared_variant_count").alias("declared")
    )
    return ck.count_mismatches(declared, view(spark, sf_dir, "pgs_variants"), ["pgs_id"])


def gram_violations(spark, sf_dir):
    loadings = view(spark, sf_dir, "pca_loadings").select("model_id", F.array("l1", "l2").alias("loadings"))
    return ck.gram_violations(loadings, 1e-6)


def summary_mismatches(spark, sf_dir):
    """Score summaries of all components against metadata that says mean 0 and deviation 0.125 of each."""
    scores = suite_structure._scores(spark, sf_dir)
    declared = spark.range(1, suite_structure.K + 1).select(
        F.col("id").cast("int").alias("component_index"),
        F.lit(0.0).alias("declared_mean"),
        F.lit(0.125).alias("declared_sd"),
    )
    out = ck.summary_mismatches(scores, declared, 0.004)
    return out.select(
        "component_index",
        F.round("score_mean", 6).alias("score_mean"),
        F.round("score_sd", 6).alias("score_sd"),
    )


def bundle_rule_violations(spark, sf_dir):
    rules = view(spark, sf_dir, "pgx_alleles").where("a <> 1").select(
        F.concat(F.lit("rule-"), F.col("allele_id")).alias("rule_id"),
        F.col("allele_id").alias("allele_a"),
        F.col("allele_id").alias("allele_b"),
        (F.col("g") % 2 == 0).alias("historical_mapping"),
    )
    constraints = view(spark, sf_dir, "pgx_constraints").withColumn(
        "state",
        F.when(F.substring("locus_id", -2, 2) == "17", "unsupported_structural_requirement").otherwise(
            F.col("state")
        ),
    ).where(F.substring("allele_id", -3, 3) != "002")
    return ck.pgx_rule_violations(
        view(spark, sf_dir, "pgx_genes"), view(spark, sf_dir, "pgx_alleles"), constraints, rules
    )


def mixed_releases(spark, sf_dir):
    return ck.mixed_releases(view(spark, sf_dir, "pgx_alleles"))


def _pgx_bundle(spark, sf_dir):
    """A pharmacogene bundle written from the views, with faults of every kind in some of its rows."""
    genes, loci = view(spark, sf_dir, "pgx_genes"), view(spark, sf_dir, "pgx_loci")
    alleles, constraints = view(spark, sf_dir, "pgx_alleles"), view(spark, sf_dir, "pgx_constraints")
    tables = {
        "sources": alleles.select("source_id").distinct().selectExpr(
            "source_id", "'1' as version", "case source_id when 'src1' then 'http' else 'https' end || '://example.org/' || source_id as url",
            "sha2(source_id, 256) as sha256", "'open' as license", "source_id as content_fingerprint",
        ),
        # a gene in 39 is not written, one in 51 is written twice, one in 33 has a strategy that is none
        "genes": genes.where("g % 39 <> 12").selectExpr(
            "gene_id", "case when g % 33 = 9 then 'guess' else strategy end as strategy", "explode(sequence(1, if(g % 51 = 15, 2, 1))) as copy"
        ),
        # positions are text; some are no numbers, some not positive
        "loci": loci.selectExpr(
            "locus_id", "gene_id", "assembly", "chromosome",
            "case when p % 37 = 5 then 'x' || position when p % 41 = 6 then '-1' else cast(position as string) end as position",
            "case when p % 43 = 7 then alternate else reference end as reference",
            "case when p % 47 = 8 then lower(alternate) else alternate end as alternate",
        ),
        "alleles": alleles.selectExpr(
            "allele_id", "gene_id", "case when g % 45 = 6 and a = 1 then null else status end as status",
            "case when g % 63 = 9 and a = 2 then 'src9' else source_id end as source_id", "source_version",
        ),
        "allele_locus_constraints": constraints.selectExpr(
            "allele_id", "locus_id",
            "case when length(allele_id || locus_id || state) * cast(substr(locus_id, 2, 9) as int) % 61 = 3 then 'unsupported_structural_requirement'"
            " when length(allele_id || locus_id || state) * cast(substr(locus_id, 2, 9) as int) % 61 = 4 then 'maybe' else state end as state",
        ),
        # allele 1 with allele 3, which is retired; every second rule says that it is historical
        "diplotype_phenotype_rules": genes.selectExpr(
            "'rule-' || gene_id as rule_id", "gene_id", "gene_id || '*001' as allele_a",
            "case when g % 57 = 6 then 'none' else gene_id || '*003' end as allele_b", "'src' || g % 2 as source_id", "'v1' as source_version",
            "if(g % 2 = 0, true, null) as historical_mapping",
        ),
    }
    return _written(spark, tables)


def pgx_bundle_violations(spark, sf_dir):
    """A tampered pharmacogene bundle: bad fields, repeated keys, lost parents, unsupported sites, retired alleles, mixed releases."""
    return bundles.validated(spark, _pgx_bundle(spark, sf_dir), "pharmacogene", bundles.validate_pharmacogene_bundle)


def observation_violations(spark, sf_dir):
    """Observation rules over all calls, with alleles taken from some called rows and given to some rows without a call."""
    rows = view(spark, sf_dir, "calls").selectExpr(
        "sample_id || '|' || source_marker_id || '|' || l_orderkey || '|' || l_linenumber as id",
        "if(raw_genotype = '--', 'no_call', 'called') as call_status",
        "case when raw_genotype = '--' then if(p % 29 = 3, array('A'), array()) when p % 23 = 4 then array() else split(raw_genotype, '') end as alleles",
    )
    return ck.broken_rules(rows, ck.OBSERVATION_RULES, "id")


def _written(spark, tables):
    root = f"{checkpoint_root(spark)}/varloom-derived/{uuid.uuid4().hex}/bundle"
    for name, rows in tables.items():
        rows.write.parquet(f"{root}/{name}")
    return root


def score_bundle_violations(spark, sf_dir):
    """A tampered score bundle: invalid weights, foreign effect alleles, lost models, wrong counts, and no exclusions at all."""
    models, variants = view(spark, sf_dir, "pgs_models"), view(spark, sf_dir, "pgs_variants")
    root = _written(
        spark,
        {
            "models": models.where("key % 58 <> 10").selectExpr(
                "pgs_id", "model_version", "if(key % 62 = 12, 'GRCh37', 'GRCh38') as assembly", "'https://example.org/' || pgs_id as source_url",
                "if(key % 74 = 14, null, 'open') as license", "declared_variant_count", "completeness_policy",
            ),
            "model_variants": variants.selectExpr(
                "pgs_id", "assembly", "chromosome", "position", "reference", "alternate",
                "if(p % 59 = 5, if(reference <> 'T' and alternate <> 'T', 'T', 'N'), effect_allele) as effect_allele", "effect_weight",
            ),
        },
    )
    return bundles.validated(spark, root, "score", bundles.validate_score_bundle)


def projection_bundle_violations(spark, sf_dir):
    """A tampered projection bundle: short vectors, unknown groups, wrong counts, loadings that are not orthonormal, wrong summaries."""
    loadings = view(spark, sf_dir, "pca_loadings").where("model_id = 'pca1'")
    scores = view(spark, sf_dir, "pca_scores").selectExpr(
        "reference_sample_id", "if(vec_id % 97 = 5, 'g-none', reference_group_id) as reference_group_id",
        "slice(cast(embedding as array<double>), 1, if(vec_id % 89 = 7, 1, 2)) as scores",
    )
    groups = scores.groupBy("reference_group_id").count().where("reference_group_id <> 'g-none'").selectExpr(
        "reference_group_id", "if(reference_group_id = 'g1', count + 1, count) as declared_sample_count"
    )
    right = pj.component_spread(scores.where("size(scores) = 2"))
    root = _written(
        spark,
        {
            "variant_loadings": loadings.selectExpr(
                "model_variant_id", "assembly", "chromosome", "position", "reference", "alternate",
                "if(p % 61 = 6, reference, effect_allele) as effect_allele", "if(p % 67 = 8, array(l1), array(l1, l2)) as loadings",
            ),
            "reference_scores": scores,
            "reference_groups": groups,
            "component_metadata": right.selectExpr(
                "component_index", "score_mean as declared_mean", "if(component_index = 2, score_sd + 1, score_sd) as declared_sd"
            ),
        },
    )
    return bundles.validated(spark, root, "projection", lambda tables: bundles.validate_projection_bundle(tables, 2, 1e-6))


def order_violations(spark, sf_dir):
    """Model variants read in key order, checked for canonical (text) order of their position."""
    rows = view(spark, sf_dir, "pgs_variants").select("p", "pgs_id", "chromosome", "position")
    return ck.order_violations(rows, [], "p", ["chromosome", "position"])


def mapping_violations(spark, sf_dir):
    """Mapping rules over the normalised cohort after deliberate edits to some rows."""
    rows = suite_normalize.mapped(spark, sf_dir)
    marker = F.regexp_extract("source_marker_id", "([0-9]+)", 1).cast("bigint")
    edited = rows.withColumns(
        {
            "variant_id": F.when(marker % 19 == 3, F.lit(None)).otherwise(F.col("variant_id")),
            "reference_validation": F.when(marker % 23 == 4, F.lit("mismatch")).otherwise(
                F.col("reference_validation")
            ),
            "candidate_count": F.when(marker % 29 == 5, F.lit(0)).otherwise(F.col("candidate_count")),
            "outcome": F.when(marker % 31 == 6, F.lit("failed")).otherwise(F.col("outcome")),
        }
    )
    return ck.broken_rules(edited, ck.MAPPING_RULES, "sample_id", "source_line_number")


def record_violations(spark, sf_dir):
    """Variant, link, inference and provenance rules over rows derived from the tables."""
    variants = view(spark, sf_dir, "variants").withColumns(
        {
            "alternate": F.when(F.col("p") % 13 == 2, F.lower("alternate"))
            .when(F.col("p") % 17 == 3, F.col("reference"))
            .otherwise(F.col("alternate")),
            "position": F.when(F.col("p") % 19 == 4, F.lit(0)).otherwise(F.col("position")),
        }
    )
    links = suite_links(spark, sf_dir)
    inference = table(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("id"),
        F.create_map(
            F.lit("hom_ref"), F.col("l_discount"),
            F.lit("het"), F.col("l_tax"),
            F.lit("hom_alt"),
            F.when(F.col("l_partkey") % 7 == 1, F.lit(-0.25)).otherwise(
                1 - F.col("l_discount") - F.col("l_tax")
            ),
        ).alias("genotype_probabilities"),
        F.when(F.col("l_partkey") % 11 == 2, F.lit(2.5)).otherwise(2 * F.col("l_tax")).alias("dosage"),
    )
    runs = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.col("o_orderdate").alias("started_at"),
        (F.col("o_orderdate") + F.expr("make_dt_interval(0, cast(o_orderkey % 5 - 1 as int))")).alias(
            "completed_at"
        ),
    )
    return ck.union(
        ck.broken_rules(
            variants.withColumn("id", F.col("variant_id")), ck.VARIANT_RULES, "id"
        ),
        ck.broken_rules(links.withColumn("id", F.col("representation_id")), ck.LINK_RULES, "id"),
        ck.broken_rules(inference, ck.INFERENCE_RULES, "id"),
        ck.broken_rules(runs, ck.PROVENANCE_RULES, "id"),
    )


def suite_links(spark, sf_dir):
    rows = lk.exact_allele_links(
        view(spark, sf_dir, "representations"), view(spark, sf_dir, "variants")
    )
    number = F.substring("representation_id", 5, 20).cast("bigint")
    return rows.withColumn(
        "variant_id", F.when(number % 9 == 2, F.lit(None)).otherwise(F.col("variant_id"))
    )


def lineage_violations(spark, sf_dir):
    """Genotype rows whose run is not the run declared for their subject."""
    runs = view(spark, sf_dir, "members").select(
        F.col("subject_id").alias("sample_id"),
        F.when(F.col("s") % 6 == 5, F.lit("run-other")).otherwise(F.col("run_id")).alias("declared_run"),
    )
    used = (
        view(spark, sf_dir, "calls")
        .groupBy("sample_id", F.concat(F.lit("run-"), F.col("s").cast("string")).alias("run_id"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    return used.join(runs, "sample_id", "left").where(
        "declared_run is null or run_id <> declared_run"
    )


QUERIES = {
    f.__name__: f
    for f in (
        extract_rows,
        merged_extracts,
        two_tier_lookup,
        coverage_partition,
        marker_resources,
        cross_build_map,
        ambiguous_markers,
        unresolved_markers,
        resource_statistics,
        fk_violations,
        uniqueness_violations,
        count_mismatches,
        gram_violations,
        summary_mismatches,
        bundle_rule_violations,
        mixed_releases,
        order_violations,
        observation_violations,
        pgx_bundle_violations,
        score_bundle_violations,
        projection_bundle_violations,
        mapping_violations,
        record_violations,
        lineage_violations,
    )
}

_SRC = """
src as (select track, replace(chrom,'chr','') as chromosome, start0+1 as position, name as marker_id,
   ref as reference, rtrim(alts,',') as alternates, string_split(rtrim(alts,','),',') as al
   from bed_rows),
ti as (select m.marker_id, case when m.marker_id in (select marker_id from src where track='common')
    then 'common' when m.marker_id in (select marker_id from src where track='clinvar')
    then 'clinvar' else 'unresolved' end as tier from (select distinct marker_id from source_markers) m),
tr as (select distinct s.chromosome, s.position, s.marker_id, s.reference, s.alternates, s.al
  from src s join ti on ti.marker_id=s.marker_id and ti.tier=s.track),
pl as (select tr.* from tr join source_markers m using (marker_id, chromosome, position)
  where m.marker_id like 'rs%'),
amb as (select marker_id, count(*) as placements from pl group by 1 having count(*)>1),
acc as (select * from pl where marker_id not in (select marker_id from amb)),
df as (select distinct marker_id, chromosome, position, reference, alternate
  from (select *, unnest(al) as alternate from acc)
  where length(reference)=1 and length(alternate)=1 and reference<>alternate),
tg as (select replace(chrom,'chr','') as cand_chromosome, start0 as cand_pos0, name as marker_id,
   ref as reference, unnest(string_split(rtrim(alts,','),',')) as alternate from target_rows),
cb as (select distinct df.marker_id, df.chromosome, df.position-1 as pos0, cand_chromosome, cand_pos0
  from df join tg using (marker_id, reference, alternate))
"""
_B = ctes("source_markers", "bed_rows", "target_rows") + "," + _SRC
_IDN = "cast(regexp_extract(marker_id,'([0-9]+)',1) as bigint)"

ORACLE = {
    "extract_rows": _B
    + " select track, chromosome, position, marker_id, reference, alternates, null::varchar as violation from src",
    "merged_extracts": _B
    + """ select distinct chromosome, position, marker_id, reference, alternates,
 null::varchar as violation from src""",
    "two_tier_lookup": _B + " select * from ti",
    "coverage_partition": _B
    + f""", f as (select marker_id, true as requested, n%17<>4 and n%19<>5 as covered,
   tier<>'unresolved' and n%17<>4 as returned, tier='unresolved' and n%17<>4 as missing,
   n%17=4 as indeterminate from (select *, {_IDN} as n from ti))
 select * from f where (returned or missing)<>covered or covered=indeterminate""",
    "marker_resources": _B
    + """ select marker_id, 'GRCh37' as assembly, chromosome, position, reference, alternate,
 'none' as orientation, true as orientation_authoritative, marker_id as rsid from df""",
    "cross_build_map": _B + " select * from cb",
    "ambiguous_markers": _B + " select * from amb",
    "unresolved_markers": _B
    + """ select marker_id, chromosome as source_chromosome, position as source_coordinate,
 case when marker_id not in (select marker_id from tr) then 'absent'
  when marker_id not in (select marker_id from pl) then 'coordinate-incompatible'
  when (select count(*) from tr where tr.marker_id=m.marker_id)>1 then 'ambiguous'
  else 'unsupported' end as reason
 from source_markers m where marker_id like 'rs%' and marker_id not in (select marker_id from df)""",
    "resource_statistics": _B
    + """, n as (select (select count(*) from source_markers) a,
  (select count(distinct marker_id) from source_markers where marker_id like 'rs%') b,
  (select count(distinct marker_id) from df) c, (select count(*) from df) d,
  (select count(distinct marker_id) from cb) e, (select count(distinct marker_id) from acc) f,
  (select count(*) from amb) g)
 select 'source_marker_count' as statistic, cast(a as double) as value from n
 union all select 'rsid_marker_count', b from n union all select 'defined_marker_count', c from n
 union all select 'definition_count', d from n
 union all select 'cross_build_mapped_marker_count', e from n
 union all select 'exact_source_placement_count', f from n
 union all select 'ambiguous_marker_count', g from n
 union all select 'unsupported_marker_count', greatest(f-c,0) from n
 union all select 'requested_canonical_rsid_count', b from n
 union all select 'unresolved_marker_count', b-c from n
 union all select 'unresolved_fraction', round((b-c)/b,6) from n
 union all select 'gross_coverage_observed_fraction', round(f/b,6) from n""",
    "fk_violations": ctes(
        "genotypes", "variants", "assertions", "representations", "pgx_constraints", "pgx_alleles",
        "pca_scores", "calls", "members",
    )
    + """ select 'genotype_variant' as "check", variant_id as key, count(*) as rows from genotypes
  where variant_id not in (select variant_id from variants) group by variant_id
 union all select 'assertion_representation', representation_id, count(*) from assertions
  where representation_id not in (select representation_id from representations
   where variation_type='SimpleAllele') group by 2
 union all select 'constraint_allele', allele_id, count(*) from pgx_constraints
  where allele_id not in (select allele_id from pgx_alleles where status='active') group by 2
 union all select 'score_group', reference_group_id, count(*) from pca_scores
  where reference_group_id='g3' group by 2
 union all select 'call_subject', sample_id, count(*) from calls
  where sample_id not in (select subject_id from members where s%23<>5) group by 2""",
    "uniqueness_violations": ctes("variants", "marker_defs", "calls")
    + """ select 'variant_key' as "check", concat_ws('|',assembly,chromosome,position,reference,alternate)
  as key, count(*) as rows from variants group by 2 having count(*)>1
 union all select 'marker_id', marker_id, count(*) from marker_defs group by 2 having count(*)>1
 union all select 'sample_marker', sample_id||'|'||source_marker_id, count(*) from calls
  group by 2 having count(*)>1""",
    "count_mismatches": ctes("pgs_models", "pgs_variants")
    + """ select pgs_id, declared_variant_count as declared,
 (select count(*) from pgs_variants v where v.pgs_id=m.pgs_id) as actual from pgs_models m
 where declared_variant_count<>(select count(*) from pgs_variants v where v.pgs_id=m.pgs_id)""",
    "gram_violations": ctes("pca_loadings")
    + """, g as (select model_id, sum(l1*l1) a, sum(l1*l2) b, sum(l2*l2) d from pca_loadings group by 1),
 e as (select model_id, 0 as "row", 0 as "column", a as value, 1 as one from g union all
   select model_id,0,1,b,0 from g union all select model_id,1,0,b,0 from g
   union all select model_id,1,1,d,1 from g)
 select model_id, "row", "column", value from e where abs(value-one)>1e-6""",
    "summary_mismatches": """select component_index, round(m,6) as score_mean, round(s,6) as score_sd from (
  select i as component_index, avg(cast(embedding[i] as double)) as m, stddev_pop(cast(embedding[i] as double)) as s
  from embeddings, range(1,65) t(i) group by 1)
 where abs(m)>0.004 or abs(s-0.125)>0.004""",
    "bundle_rule_violations": ctes("pgx_genes", "pgx_loci", "pgx_alleles", "pgx_constraints")
    + """, c as (select allele_id, case when right(locus_id,2)='17' then 'unsupported_structural_requirement'
   else state end as state from pgx_constraints where right(allele_id,3)<>'002')
 select 'allele_without_constraint' as rule, allele_id as key from pgx_alleles
  where allele_id not in (select allele_id from c)
 union all select distinct 'structural_constraint_in_matchable_gene', allele_id from c
  join pgx_alleles a using (allele_id) join pgx_genes g on g.gene_id=a.gene_id
  where c.state='unsupported_structural_requirement' and g.strategy='star_haplotype_small_variant'
 union all select 'retired_allele_rule', 'rule-'||allele_id from pgx_alleles
  where status='retired' and a<>1 and g%2<>0""",
    "mixed_releases": ctes("pgx_alleles")
    + """ select gene_id, source_id, count(distinct source_version) as versions from pgx_alleles
 group by all having count(distinct source_version)>1""",
    "pgx_bundle_violations": ctes("pgx_genes", "pgx_loci", "pgx_alleles", "pgx_constraints")
    + """, ge as (select gene_id, g, case when g%33=9 then 'guess' else strategy end as strategy from pgx_genes where g%39<>12),
 lo as (select locus_id, gene_id, p, chromosome, case when p%37=5 then null when p%41=6 then -1 else position end as position,
   case when p%43=7 then alternate else reference end as reference, case when p%47=8 then lower(alternate) else alternate end as alternate
   from pgx_loci),
 al as (select allele_id, gene_id, g, a, case when g%45=6 and a=1 then null else status end as status,
   case when g%63=9 and a=2 then 'src9' else source_id end as source_id, source_version from pgx_alleles),
 co as (select allele_id, locus_id, case when (length(allele_id||locus_id||state)*cast(substr(locus_id,2,9) as int))%61=3 then 'unsupported_structural_requirement'
    when (length(allele_id||locus_id||state)*cast(substr(locus_id,2,9) as int))%61=4 then 'maybe' else state end as state from pgx_constraints),
 ru as (select 'rule-'||gene_id as rule_id, gene_id, g, gene_id||'*001' as allele_a,
   case when g%57=6 then 'none' else gene_id||'*003' end as allele_b, 'src'||(g%2) as source_id, 'v1' as source_version,
   g%2=0 as historical from pgx_genes),
 cited as (select gene_id, source_id, source_version from al union all select gene_id, source_id, source_version from ru)
 select 'sources' as table_name, 'src1' as key, 'url' as field, 'rule' as problem where exists (select 1 from pgx_alleles where source_id='src1')
 union all select 'genes', gene_id, 'strategy', 'rule' from ge, range(0,2) t(i) where strategy='guess' and i<case when g%51=15 then 2 else 1 end
 union all select 'genes', gene_id, '', 'duplicate_key' from ge where g%51=15
 union all select 'loci', locus_id, 'position', case when position is null then 'type' else 'rule' end from lo where coalesce(position,0)<=0
 union all select 'loci', locus_id, 'alternate', 'rule' from lo where p%47=8
 union all select 'loci', locus_id, 'chromosome', 'unsupported_site' from lo where reference=alternate
 union all select 'loci', locus_id, 'gene_id', 'unknown_parent' from lo where gene_id not in (select gene_id from ge)
 union all select 'alleles', allele_id, 'status', 'null' from al where status is null
 union all select 'alleles', allele_id, 'source_id', 'unknown_parent' from al where source_id='src9'
 union all select 'alleles', allele_id, 'gene_id', 'unknown_parent' from al where gene_id not in (select gene_id from ge)
 union all select 'alleles', allele_id, '', 'allele_without_constraint' from al where allele_id not in (select allele_id from co)
 union all select 'alleles', allele_id, '', 'structural_constraint_in_matchable_gene' from al join ge using (gene_id), range(0,2) t(i)
   where strategy='star_haplotype_small_variant' and i<case when ge.g%51=15 then 2 else 1 end
   and allele_id in (select allele_id from co where state='unsupported_structural_requirement')
 union all select 'allele_locus_constraints', allele_id||'|'||locus_id, 'state', 'rule' from co where state='maybe'
 union all select 'diplotype_phenotype_rules', rule_id, 'allele_b', 'unknown_parent' from ru where allele_b not in (select allele_id from al)
 union all select 'diplotype_phenotype_rules', rule_id, 'allele_a', 'unknown_parent' from ru where allele_a not in (select allele_id from al)
 union all select 'diplotype_phenotype_rules', rule_id, '', 'retired_allele_rule' from ru where not historical
   and (allele_a in (select allele_id from al where status='retired') or allele_b in (select allele_id from al where status='retired'))
 union all select 'sources', gene_id||'|'||source_id, 'source_version', 'mixed_releases' from cited group by gene_id, source_id
   having count(distinct source_version)>1""",
    "score_bundle_violations": ctes("pgs_models", "pgs_variants")
    + """, m as (select * from pgs_models where key%58<>10),
 v as (select *, concat_ws('|',pgs_id,assembly,chromosome,position,reference,alternate) as site,
   case when p%59=5 then case when reference<>'T' and alternate<>'T' then 'T' else 'N' end else effect_allele end as eff from pgs_variants)
 select 'model_exclusions' as table_name, '' as key, '' as field, 'table_missing' as problem
 union all select 'models', pgs_id, 'assembly', 'rule' from m where key%62=12
 union all select 'models', pgs_id, 'license', 'null' from m where key%74=14
 union all select 'model_variants', site, 'effect_allele', 'rule' from v where eff='N'
 union all select 'model_variants', site, 'effect_allele', 'not_an_allele' from v where eff not in (reference, alternate)
 union all select 'model_variants', site, 'effect_weight', 'no_exact_number' from v where p%97 in (13,14,15)
 union all select 'model_variants', site, 'pgs_id', 'unknown_parent' from v where pgs_id not in (select pgs_id from m)
 union all select 'models', pgs_id, 'declared_variant_count', 'count_mismatch' from m
   where declared_variant_count<>(select count(*) from pgs_variants v where v.pgs_id=m.pgs_id)""",
    "projection_bundle_violations": ctes("pca_loadings", "pca_scores")
    + """, l as (select * from pca_loadings where model_id='pca1'), w as (select * from l where p%67<>8),
 s as (select *, case when vec_id%97=5 then 'g-none' else reference_group_id end as gid from pca_scores)
 select 'variant_loadings' as table_name, model_variant_id as key, 'chromosome' as field, 'unsupported_site' as problem from l where p%61=6
 union all select 'variant_loadings', model_variant_id, 'loadings', 'vector_length' from l where p%67=8
 union all select 'reference_scores', reference_sample_id, 'scores', 'vector_length' from s where vec_id%89=7
 union all select 'reference_scores', reference_sample_id, 'reference_group_id', 'unknown_parent' from s where gid='g-none'
 union all select 'reference_groups', 'g1', 'declared_sample_count', 'count_mismatch' where exists (select 1 from s where gid='g1')
 union all select 'component_metadata', '2', 'declared_mean', 'summary_mismatch'
 union all select 'variant_loadings', '1,1', 'loadings', 'not_orthonormal' from (select sum(l1*l1) q from w) where abs(q-1)>1e-6
 union all select 'variant_loadings', k, 'loadings', 'not_orthonormal' from (select sum(l1*l2) q from w), (values ('1,2'),('2,1')) t(k) where abs(q)>1e-6
 union all select 'variant_loadings', '2,2', 'loadings', 'not_orthonormal' from (select sum(l2*l2) q from w) where abs(q-1)>1e-6""",
    "order_violations": ctes("pgs_variants")
    + """, l as (select p, pgs_id, chromosome, position, lag(chromosome) over (order by p) as c0,
   lag(position) over (order by p) as p0 from pgs_variants)
 select p, pgs_id, chromosome, position from l
 where chromosome<c0 or (chromosome=c0 and position<=p0)""",
    "mapping_violations": suite_normalize._NUM
    + ","
    + suite_normalize.mapped_sql("numbered_calls")
    + """, e as (select sample_id, source_line_number, target_chromosome, liftover_required,
   liftover_status, case when p%19=3 then null else variant_id end as variant_id,
   case when p%23=4 then 'mismatch' else reference_validation end as rv,
   case when p%29=5 then 0 else candidate_count end as cc,
   case when p%31=6 then 'failed' else outcome end as outcome from mapped)
 select sample_id, source_line_number, 'mapped_has_target' as rule from e
  where outcome='mapped' and variant_id is null
 union all select sample_id, source_line_number, 'mapped_reference_match' from e
  where outcome='mapped' and rv<>'match'
 union all select sample_id, source_line_number, 'mapped_liftover_success' from e
  where outcome='mapped' and liftover_required and liftover_status<>'success'
 union all select sample_id, source_line_number, 'unmapped_has_no_variant' from e
  where outcome<>'mapped' and variant_id is not null
 union all select sample_id, source_line_number, 'ambiguous_has_candidates' from e
  where outcome='ambiguous' and cc=0""",
    "observation_violations": ctes("calls")
    + """, r as (select sample_id||'|'||source_marker_id||'|'||l_orderkey||'|'||l_linenumber as id, raw_genotype='--' as none, p from calls)
 select id, 'called_has_alleles' as rule from r where not none and p%23=4
 union all select id, 'uncalled_has_none' from r where none and p%29=3""",
    "record_violations": ctes("variants", "representations")
    + """,
 va as (select variant_id as id, p, reference, case when p%13=2 then lower(alternate)
   when p%17=3 then reference else alternate end as alternate,
   case when p%19=4 then 0 else position end as position from variants),
 li as (select r.representation_id as id, r.p, count(v.variant_id) as n from representations r
   left join variants v using (assembly, chromosome, position, reference, alternate)
   where r.variation_type='SimpleAllele' and r.assembly='GRCh38' and r.alternate is not null
   group by all),
 inf as (select concat_ws('-',l_orderkey,l_linenumber,l_partkey,l_suppkey) as id, l_discount a, l_tax b,
   case when l_partkey%7=1 then -0.25 else 1-l_discount-l_tax end c,
   case when l_partkey%11=2 then 2.5 else 2*l_tax end d from lineitem)
 select id, 'position_positive' as rule from va where position<=0
 union all select id, 'alleles_upper' from va where alternate<>upper(alternate)
 union all select id, 'alleles_differ' from va where alternate=reference
 union all select id, 'matched_iff_variant' from li where n=1 and p%9=2
 union all select id, 'probabilities_in_range' from inf
  where not (a between 0 and 1 and b between 0 and 1 and c between 0 and 1)
 union all select id, 'probabilities_sum_to_one' from inf where not abs(a+b+c-1)<=1e-6
 union all select id, 'dosage_in_range' from inf where not d between 0 and 2
 union all select cast(o_orderkey as varchar), 'completed_not_before_started' from orders
  where o_orderkey%5=0""",
    "lineage_violations": ctes("calls", "members")
    + """, u as (select sample_id, 'run-'||s as run_id, count(*) as rows from calls group by all)
 select u.sample_id, u.run_id, u.rows, 'run-other' as declared_run from u
 join members m on m.subject_id=u.sample_id where m.s%6=5""",
}
