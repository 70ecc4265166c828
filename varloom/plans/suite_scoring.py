"""Registered score queries and their SQL counterparts."""

from pyspark.sql import functions as F

from varloom.functions.alleles import foreign_code
from varloom.operators import scoring as sc
from varloom.operators.calls import collapse
from varloom.plans.driver_views import ctes, view


def genotypes(spark, sf_dir):
    """Canonical genotypes with the code of any allele outside REF/ALT."""
    rows = view(spark, sf_dir, "genotypes").withColumn(
        "alleles",
        F.when(F.col("ploidy") == 2, F.array(F.substring("pair", 1, 1), F.substring("pair", 2, 1)))
        .otherwise(F.array("pair")),
    )
    return rows.withColumn(
        "foreign_code", foreign_code(F.col("alleles"), F.col("reference"), F.col("alternate"))
    )


def calls(spark, sf_dir):
    return collapse(genotypes(spark, sf_dir))


def _model(spark, sf_dir):
    return sc.parsed_weights(view(spark, sf_dir, "pgs_variants"))


def _scores(spark, sf_dir):
    return sc.scores(
        calls(spark, sf_dir),
        _model(spark, sf_dir),
        view(spark, sf_dir, "pgs_models"),
        view(spark, sf_dir, "pgs_requests"),
    )


def collapsed_calls(spark, sf_dir):
    return calls(spark, sf_dir).select(
        "sample_id", "variant_id", "call_count", "foreign_count", "max_alt", "min_alt",
        "min_ploidy", "max_ploidy", "valid_low", "valid_high",
        (F.col("low_code") == F.col("high_code")).alias("agreed"),
    )


def pgs_alignment(spark, sf_dir):
    out = sc.alignment(
        calls(spark, sf_dir), _model(spark, sf_dir), view(spark, sf_dir, "pgs_requests")
    )
    return out.withColumn("contribution", F.col("contribution").cast("string"))


def pgs_scores(spark, sf_dir):
    return _scores(spark, sf_dir).withColumns(
        {
            "raw_partial_score": F.col("raw_partial_score").cast("string"),
            "marker_coverage": F.round("marker_coverage", 6),
            "absolute_weight_coverage": F.round("absolute_weight_coverage", 6),
        }
    )


def pgs_reference_midrank(spark, sf_dir):
    out = sc.compare_reference(
        _scores(spark, sf_dir), view(spark, sf_dir, "pgs_reference"), ["pgs_id", "model_version"]
    )
    return out.withColumns(
        {"z_score": F.round("z_score", 6), "percentile": F.round("percentile", 6)}
    )


QUERIES = {
    f.__name__: f for f in (collapsed_calls, pgs_alignment, pgs_scores, pgs_reference_midrank)
}

_SORTED = "case when length(pair)=2 and pair[1]>pair[2] then pair[2]||pair[1] else pair end"
CALL_SQL = f"""
cg as (select *, {_SORTED} as multiset from genotypes),
cc as (select sample_id, variant_id, count(*) as call_count,
  count(*) filter (foreign_bases<>'') as foreign_count,
  count(distinct multiset) as multisets, max(alt_count) as max_alt, min(alt_count) as min_alt,
  min(ploidy) as min_ploidy, max(ploidy) as max_ploidy,
  count(*) filter (ploidy=2) as dips,
  count(distinct multiset) filter (ploidy=2) as dip_sets,
  bool_or(foreign_bases<>'') filter (ploidy=2) as dip_foreign,
  min(alt_count) filter (ploidy=2 and foreign_bases='') as valid_low,
  max(alt_count) filter (ploidy=2 and foreign_bases='') as valid_high
  from cg group by sample_id, variant_id)
"""
_TEN18 = "1000000000000000000::hugeint"


def _shown(total: str) -> str:
    """A number of 18 fractional digits from its whole number of 10^-18."""
    return (
        f"case when {total}<0 then '-' else '' end || cast(abs({total})//{_TEN18} as varchar) || '.'"
        f" || lpad(cast(abs({total})%{_TEN18} as varchar),18,'0')"
    )


# Weights are read from their text: sign, whole part and fraction as huge integers, apart.
_ALIGN = f"""
pw as (select *, case when effect_weight like '-%' then -1 else 1 end as sg,
  split_part(ltrim(effect_weight,'-'),'.',1) as tw, rtrim(split_part(effect_weight,'.',2),'0') as tf from pgs_variants),
pv as (select *, coalesce(regexp_matches(effect_weight,'^-?[0-9]+([.][0-9]+)?$') and length(tf)<=18
   and try_cast(tw as hugeint)<50000000000000000000::hugeint, false) as good,
  sg*try_cast(tw as hugeint) as wi, sg*try_cast(rpad(tf,18,'0') as hugeint) as wf from pw),
al as (select r.sample_id, v.*, c.valid_low, case when not good then 'MODEL_WEIGHT_INVALID'
    when coalesce(c.dips,0)=0 then 'TARGET_VARIANT_MISSING'
    when c.dip_sets>1 then 'DUPLICATE_OBSERVATION_CONFLICT'
    when c.dip_foreign then 'TARGET_ALLELE_INCOMPATIBLE' end as reason
  from pgs_requests r join pv v using (pgs_id)
  left join cc c on c.sample_id=r.sample_id and c.variant_id=v.variant_id),
am as (select *, case when effect_allele=alternate then valid_low else 2-valid_low end as dose from al),
sc0 as (select sample_id, pgs_id, count(*) as n, count(*) filter (reason is null) as c,
  coalesce(sum(wi*dose) filter (reason is null),0) as si, coalesce(sum(wf*dose) filter (reason is null),0) as sf,
  sum(abs(wi)) filter (good) as ti, sum(abs(wf)) filter (good) as tf,
  sum(abs(wi)) filter (reason is null) as mi, sum(abs(wf)) filter (reason is null) as mf from am group by all),
sc1 as (select *, case when abs(si)<150000000000000000000::hugeint then cast(si as hugeint)*{_TEN18}+cast(sf as hugeint) end as raw,
  cast(ti as double)+cast(tf as double)/1e18 as ta, cast(mi as double)+cast(mf as double)/1e18 as ma from sc0),
sc2 as (select *, case when abs(raw)<100000000000000000000000000000000000000::hugeint then {_shown("raw")} end as score from sc1),
sc as (select s.*, m.model_version, case when score is null then 'not_evaluable'
    when c=n and completeness_policy='all_supported_variants_required'
    then 'evaluable' when c>0 then 'partial_not_evaluable' else 'not_evaluable' end as status
  from sc2 s join pgs_models m using (pgs_id))
"""
_BASE = ctes("genotypes", "pgs_variants", "pgs_models", "pgs_requests", "pgs_reference")

ORACLE = {
    "collapsed_calls": ctes("genotypes")
    + ","
    + CALL_SQL
    + """ select sample_id, variant_id, call_count, foreign_count, max_alt, min_alt, min_ploidy,
 max_ploidy, valid_low, valid_high, multisets=1 as agreed from cc""",
    "pgs_alignment": _BASE
    + ","
    + CALL_SQL
    + ","
    + _ALIGN
    + f""" select sample_id, pgs_id, concat_ws('|',assembly,chromosome,position,reference,alternate)
  as variant_key, case when reason is null then 'matched' else 'excluded' end as status, reason,
  case when reason is null then 'observed' end as input_source,
  case when reason is null then dose end as effect_dosage,
  case when reason is null then {_shown(f"(cast(wi*dose as hugeint)*{_TEN18}+cast(wf*dose as hugeint))")} end
  as contribution from am""",
    "pgs_scores": _BASE
    + ","
    + CALL_SQL
    + ","
    + _ALIGN
    + """ select sample_id, pgs_id, model_version, status,
 score as raw_partial_score, case when score is null then 'SCORE_OVERFLOW' end as score_reason,
 n as supported_marker_count, c as contributed_marker_count,
 n-c as missing_or_excluded_marker_count, c as observed_contributed_count,
 0 as imputed_contributed_count, round(c/n,6) as marker_coverage,
 round(case when ta>0 then coalesce(ma,0)/ta else 0 end,6)
  as absolute_weight_coverage from sc""",
    "pgs_reference_midrank": _BASE
    + ","
    + CALL_SQL
    + ","
    + _ALIGN
    + """, ref as (select pgs_id, model_version, count(*) n, avg(score) mu, var_pop(score) v
   from pgs_reference group by all),
 j as (select s.sample_id, s.pgs_id, s.model_version, s.status, cast(s.score as double) as x, r.n,
   r.mu, r.v, exists (select 1 from pgs_reference q where q.pgs_id=s.pgs_id) as known
   from sc s left join ref r on r.pgs_id=s.pgs_id and r.model_version=s.model_version),
 k as (select *, case when status<>'evaluable' then 'MODEL_NOT_EVALUABLE'
   when not known then 'REFERENCE_NOT_SELECTED' when n is null then 'REFERENCE_IDENTITY_INCOMPATIBLE'
   when n<2 then 'REFERENCE_DISTRIBUTION_INVALID' when v<=0 then 'REFERENCE_ZERO_VARIANCE' end
   as comparison_reason from j)
select sample_id, pgs_id, model_version,
 case when comparison_reason is null then 'evaluable' else 'not_evaluable' end as comparison_status,
 comparison_reason, case when comparison_reason is null then round((x-mu)/sqrt(v),6) end as z_score,
 case when comparison_reason is null then round(100*(
  (select count(*) from pgs_reference q where q.pgs_id=k.pgs_id and q.score<k.x)
  +(select count(*) from pgs_reference q where q.pgs_id=k.pgs_id and q.score<=k.x))/2.0/n,6) end
  as percentile,
 case when comparison_reason is null then n end as sample_count from k""",
}
