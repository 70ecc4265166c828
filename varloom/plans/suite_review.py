"""Registered evidence-link and review queries and their SQL counterparts."""

from pyspark.sql import functions as F

from varloom import vocab
from varloom.functions.evidence import record_status
from varloom.operators import links as lk, review as rv
from varloom.operators.calls import collapse, genotype_state
from varloom.operators.materialize import stored
from varloom.plans import reports
from varloom.plans.driver_views import RELEASE_DATE, ctes, view

POLICY = vocab.DEFAULT_POLICY


def _links(spark, sf_dir):
    return lk.exact_allele_links(
        view(spark, sf_dir, "representations"), view(spark, sf_dir, "variants")
    )


def _assertions(spark, sf_dir):
    return view(spark, sf_dir, "assertions").withColumn(
        "source_classification_terms", F.array("term")
    ).drop("term", "p")


def _routed(spark, sf_dir):
    return rv.routed_assertions(
        _links(spark, sf_dir), _assertions(spark, sf_dir), RELEASE_DATE, POLICY
    )


def _banded(spark, sf_dir):
    cohort = collapse(view(spark, sf_dir, "sample_calls"))
    return rv.banded(cohort, rv.evidence_summary(_routed(spark, sf_dir), POLICY))


def _profiles(spark, sf_dir):
    return rv.identified(_banded(spark, sf_dir), POLICY)


def genotype_states(spark, sf_dir):
    return collapse(view(spark, sf_dir, "sample_calls")).select(
        "sample_id", "variant_id", "call_count", genotype_state().alias("genotype_state")
    )


def exact_allele_links(spark, sf_dir):
    return _links(spark, sf_dir)


def link_qc(spark, sf_dir):
    return lk.histogram(_links(spark, sf_dir), outcomes="outcome", reasons="reason")


def evidence_qc(spark, sf_dir):
    rows = view(spark, sf_dir, "assertions").withColumn(
        "record_status", record_status(F.col("status_term"))
    )
    return lk.histogram(
        rows,
        assertion_levels="assertion_level",
        classification_types="classification_type",
        record_statuses="record_status",
    )


def term_routes(spark, sf_dir):
    return _routed(spark, sf_dir).select(
        "variant_id", "assertion_id", "term", "route", "review_level", "record_status",
        "age_days", "active_for_routing",
    )


def evidence_summary(spark, sf_dir):
    return rv.evidence_summary(_routed(spark, sf_dir), POLICY)


def review_queue(spark, sf_dir):
    shown = [
        "sample_id", "queue_position", "variant_id", "profile_id", "genotype_state", "band",
        "eligibility", "reason_code", "review_order", "conflict_order", "missing_order", "age_order",
    ]
    # only what is shown is dealt and stored
    rows = _profiles(spark, sf_dir).select(*[c for c in shown if c != "queue_position"])
    return rv.review_queue(rows).select(*shown)


def rationales(spark, sf_dir):
    return rv.rationales(_profiles(spark, sf_dir), POLICY)


def rationale_assertions(spark, sf_dir):
    return rv.rationale_assertions(_routed(spark, sf_dir), POLICY)


def prioritization_exclusions(spark, sf_dir):
    return rv.exclusions(_profiles(spark, sf_dir))


def candidate_assertion_links(spark, sf_dir):
    return rv.candidate_assertion_links(_routed(spark, sf_dir))


def prioritization_qc(spark, sf_dir):
    return lk.histogram(
        _profiles(spark, sf_dir).withColumn(
            "conflict", F.when(F.col("eligibility") == "data_conflict", "data_conflict")
        ),
        priority_bands="band",
        genotype_states="genotype_state",
        data_conflicts="conflict",
    )


def profile_arrays(spark, sf_dir):
    out = rv.profile_arrays(_routed(spark, sf_dir))
    return out.select(
        "variant_id",
        "row_count",
        *[
            F.array_join(c, "|", "~").alias(c)
            for c in out.columns
            if c not in ("variant_id", "row_count")
        ],
    )


def _conditions(spark, sf_dir):
    """Conditions of submitted assertions, and their links: one per submitter, a shared one for every third order."""
    rows = view(spark, sf_dir, "assertions").where("assertion_level = 'source_submitted'")
    number = F.substring("source_accession", 4, 20).cast("bigint")
    own = F.concat(F.lit("cond-"), F.translate("submitter_name", " ", "-"))
    ids = F.array_compact(F.array(own, F.when(number % 3 == 0, F.lit("cond-shared"))))
    links = rows.select("assertion_id", F.explode(ids).alias("condition_id"))
    names = links.select("condition_id").distinct()
    return links, names.withColumn("source_name", F.concat(F.lit("condition of "), F.substring("condition_id", 6, 20)))


def profile_evidence(spark, sf_dir):
    """Ids, names and submitters behind each linked variant, an array per field."""
    links, conditions = _conditions(spark, sf_dir)
    members = rv.profile_members(_links(spark, sf_dir), _assertions(spark, sf_dir), links, conditions)
    out = rv.profile_evidence(members)
    return out.select("variant_id", *[F.array_join(c, "|").alias(c) for c in rv.PROFILE_FIELDS])


def _genotypes(spark, sf_dir):
    calls = view(spark, sf_dir, "sample_calls")
    return rv.genotype_members(calls, rv.evidence_summary(_routed(spark, sf_dir), POLICY))


def profile_genotypes(spark, sf_dir):
    """Genotype rows of each profile in id order."""
    out = rv.profile_genotypes(_genotypes(spark, sf_dir))
    return out.select(
        "sample_id", "variant_id", "genotype_count",
        *[F.array_join(F.col(c).cast("array<string>"), "|").alias(c) for c in out.columns[3:]],
    )


def rationale_genotypes(spark, sf_dir):
    """Genotype and observation ids behind every rationale."""
    # profiles are dealt before they become several rationales with ids each; these stay where their genotypes will be
    dealt = _banded(spark, sf_dir).repartition("sample_id", "variant_id")
    reasons = rv.rationales(rv.identified(dealt, POLICY), POLICY)
    return rv.rationale_genotypes(reasons, _genotypes(spark, sf_dir))


def review_report(spark, sf_dir):
    """The review queue of every sample as numbered report lines."""
    # stored: the queue and the rationales both read the profiles; their ids are made from it
    kept = (
        "sample_id", "variant_id", "genotype_state", "band", "eligibility", "reason_code", "source_conflict", "unknown_active", "any_stale",
        "review_order", "conflict_order", "missing_order", "age_order",
    )
    profiles = rv.identified(stored(_banded(spark, sf_dir).select(*kept), "profiles"), POLICY)
    links, conditions = _conditions(spark, sf_dir)
    evidence = rv.profile_evidence(rv.profile_members(_links(spark, sf_dir), _assertions(spark, sf_dir), links, conditions))
    # only what a report shows is dealt and stored; a candidate's id follows from its profile
    dealt = (
        "sample_id", "variant_id", "profile_id", "genotype_state", "band", "source_conflict", "review_order", "conflict_order",
        "missing_order", "age_order",
    )
    queue = rv.with_candidates(rv.review_queue(profiles.select(*dealt)))
    return reports.review_report(queue, evidence, rv.rationales(profiles, POLICY))


QUERIES = {
    f.__name__: f
    for f in (
        review_report,
        profile_evidence,
        profile_genotypes,
        rationale_genotypes,
        genotype_states,
        exact_allele_links,
        link_qc,
        evidence_qc,
        term_routes,
        evidence_summary,
        review_queue,
        rationales,
        rationale_assertions,
        prioritization_exclusions,
        candidate_assertion_links,
        prioritization_qc,
        profile_arrays,
    )
}

_STATE = """
gs as (select sample_id, variant_id, count(alt_count) as call_count,
  case when count(alt_count)=0 then 'no_canonical_called_genotype'
    when max(alt_count)=0 then 'observed_reference_only'
    when count(distinct case when alt_count is not null then ploidy||':'||alt_count end)>1
      then 'discordant_called_rows_with_alt'
    when count(alt_count)=1 then 'single_observed_alt_call'
    else 'concordant_observed_alt_calls' end as genotype_state
  from sample_calls group by sample_id, variant_id)
"""
_LINK = """
hits as (select r.representation_id, count(v.variant_id) as hit, min(v.variant_id) as target
  from representations r left join variants v on v.assembly=r.assembly and v.chromosome=r.chromosome
    and v.position=r.position and v.reference=r.reference and v.alternate=r.alternate group by 1),
lk0 as (select r.*, hit, target, case when variation_type<>'SimpleAllele' then 'unsupported_variation_type'
    when alternate is null then 'incomplete_allele_identity'
    when assembly<>'GRCh38' then 'assembly_incompatible'
    when hit>1 then 'multiple_canonical_targets' when hit=0 then 'allele_not_in_normalization_run'
    else 'exact_allele_match' end as reason
  from representations r join hits using (representation_id)),
links as (select *, case reason when 'exact_allele_match' then 'matched'
    when 'allele_not_in_normalization_run' then 'unmatched'
    when 'multiple_canonical_targets' then 'ambiguous'
    when 'unsupported_variation_type' then 'unsupported' else 'incompatible' end as outcome,
  case when reason='exact_allele_match' then target end as variant_id from lk0)
"""


def _norm(column):
    return f"trim(regexp_replace(lower({column}), '\\s+', ' ', 'g'))"


def _terms_sql():
    lines = []
    for route, terms in POLICY["term_routes"].items():
        if terms:
            listed = ",".join("'" + t.lower() + "'" for t in terms)
            lines.append(f"when {_norm('term')} in ({listed}) then '{route}'")
    return "case " + " ".join(lines) + " else 'unmapped_source_term' end"


def _levels_sql():
    lines = [
        f"when {_norm('review_status')} = '{k}' then '{v}'"
        for k, v in POLICY["source_review_status_mappings"].items()
    ]
    return "case " + " ".join(lines) + " else 'unknown' end"


_ROUTED = f"""
ra as (select l.variant_id, a.*, {_terms_sql()} as route, {_levels_sql()} as review_level,
  case when lower(status_term) like '%current%' then 'current'
    when lower(status_term) like '%replac%' then 'replaced'
    when lower(status_term) like '%delet%' then 'deleted' else 'unknown' end as record_status,
  date_diff('day', date_last_evaluated, date '{RELEASE_DATE}') as age_days
  from links l join assertions a using (representation_id) where l.outcome='matched'),
routed as (select *, record_status in ('current','unknown') and classification_type='germline'
  as active_for_routing from ra)
"""
_SUMMARY = """
summary as (select variant_id,
  bool_or(active_for_routing and route='high_attention_source_term') as any_high,
  bool_or(active_for_routing and route in
    ('risk_context','uncertain','other_context','unmapped_source_term')) as any_attention,
  bool_or(active_for_routing) as any_active,
  bool_or(assertion_level='source_computed_aggregate' and classification_type='germline'
    and lower(term) like 'conflicting classification%') as source_conflict,
  bool_or(active_for_routing and record_status='unknown') as unknown_active,
  bool_or(coalesce(age_days>1825,false)) as any_stale,
  min(list_position(['practice_guideline','expert_panel','multiple_submitters','single_submitter',
    'no_assertion_criteria','unknown'], review_level)-1) as review_order,
  bool_or(date_last_evaluated is null) as missing_date, coalesce(max(age_days),-1) as age_order
  from routed group by variant_id)
"""
_PROFILE = """
pf0 as (select gs.*, s.* exclude (variant_id), genotype_state in ('single_observed_alt_call',
   'concordant_observed_alt_calls','discordant_called_rows_with_alt') as ok
  from gs join summary s using (variant_id)),
pf1 as (select *, case when not ok then 'not_eligible' when any_high then 'review_first'
    when source_conflict or any_attention then 'review_next' when any_active then 'not_prioritized'
    else 'context_only' end as band,
  'profile-'||sha256(concat_ws(chr(31),sample_id,variant_id,'clinvar-germline-review-routing','1.0.0'))
    as profile_id from pf0),
pf as (select *, case band when 'not_eligible' then genotype_state
    when 'review_first' then 'active_high_attention_source_term'
    when 'review_next' then 'active_germline_review_context'
    when 'not_prioritized' then 'benign_like_only' else 'no_active_germline_assertion' end as reason_code,
  case when not ok then 'not_eligible' when genotype_state='discordant_called_rows_with_alt'
    and band in ('review_first','review_next') then 'data_conflict' else 'eligible' end as eligibility,
  case when source_conflict then 0 else 1 end as conflict_order,
  cast(missing_date as int) as missing_order,
  'candidate-'||sha256(concat_ws(chr(31),profile_id,band)) as candidate_id from pf1)
"""
_L = ctes("representations", "variants") + "," + _LINK
_R = ctes("representations", "variants", "assertions") + "," + _LINK + "," + _ROUTED
_P = (
    ctes("representations", "variants", "assertions", "sample_calls")
    + "," + _LINK + "," + _ROUTED + "," + _SUMMARY + "," + _STATE + "," + _PROFILE
)


def _joined(expr, order):
    return f"string_agg(coalesce(cast({expr} as varchar),'~'),'|' order by {order})"


ORACLE = {
    "genotype_states": ctes("sample_calls") + "," + _STATE + " select * from gs",
    "exact_allele_links": _L
    + """ select representation_id, reason, variant_id, assembly, chromosome, position, reference,
 alternate, outcome, 'link-'||sha256(concat_ws(chr(31),representation_id,assembly,chromosome,position,
 reference,coalesce(alternate,chr(30)),outcome)) as link_id from links""",
    "link_qc": _L
    + """ select 'outcomes' as dimension, outcome as value, count(*) as n from links group by all
 union all select 'reasons', reason, count(*) from links group by all""",
    "evidence_qc": ctes("assertions")
    + """ select 'assertion_levels' as dimension, assertion_level as value, count(*) as n
 from assertions group by all
 union all select 'classification_types', classification_type, count(*) from assertions group by all
 union all select 'record_statuses', case when lower(status_term) like '%current%' then 'current'
  when lower(status_term) like '%replac%' then 'replaced' else 'unknown' end, count(*)
 from assertions group by all""",
    "term_routes": _R
    + """ select variant_id, assertion_id, term, route, review_level, record_status, age_days,
 active_for_routing from routed""",
    "evidence_summary": _R + "," + _SUMMARY + " select * from summary",
    "review_queue": _P
    + """ select sample_id, variant_id, profile_id, genotype_state, band, eligibility, reason_code,
 review_order, conflict_order, missing_order, age_order,
 row_number() over (partition by sample_id order by list_position(['review_first','review_next',
   'context_only','not_prioritized','not_eligible'], band), review_order, conflict_order,
   missing_order, age_order, profile_id) as queue_position from pf""",
    "rationales": _P
    + """, e as (
 select *, case band when 'not_eligible' then 'excludes' when 'review_first' then 'promotes'
   when 'review_next' then 'promotes' else 'contextualizes' end as rationale_type,
   reason_code as code from pf
 union all select *, 'warns', 'data_conflict_alt_carriage_unresolved' from pf
   where eligibility='data_conflict'
 union all select *, 'warns', 'unknown_record_status_active_by_policy' from pf where unknown_active
 union all select *, 'warns', 'source_evaluation_older_than_policy_threshold' from pf where any_stale)
select 'rationale-'||sha256(concat_ws(chr(31),candidate_id,code)) as rationale_id, sample_id,
 variant_id, candidate_id, profile_id, rationale_type, code as reason_code,
 case when code='data_conflict_alt_carriage_unresolved' then 'discordant-called-rows@1.0.0' else
  case band when 'review_first' then 'active-high-attention@1'
   when 'review_next' then 'active-review-context@1' when 'not_prioritized' then 'benign-only@1'
   when 'context_only' then 'context-only@1' else 'genotype-ineligible@1' end end as policy_rule
from e""",
    "rationale_assertions": _R
    + """ select variant_id, assertion_id, 'active' as role from routed where active_for_routing
 union select variant_id, assertion_id, 'unknown_record_status' from routed
  where active_for_routing and record_status='unknown'
 union select variant_id, assertion_id, 'stale' from routed where age_days>1825""",
    "prioritization_exclusions": _P
    + """ select 'exclusion-'||sha256(concat_ws(chr(31),profile_id,reason_code)) as exclusion_id,
 sample_id, variant_id, profile_id, candidate_id, reason_code from pf where band='not_eligible'""",
    "candidate_assertion_links": _R
    + """ select 'candidate-assertion-'||sha256(concat_ws(chr(31),variant_id,assertion_id,term))
  as link_id, variant_id, assertion_id, assertion_level, classification_type, term as source_term,
  route as source_term_route, active_for_routing from routed""",
    "prioritization_qc": _P
    + """ select 'priority_bands' as dimension, band as value, count(*) as n from pf group by all
 union all select 'genotype_states', genotype_state, count(*) from pf group by all
 union all select 'data_conflicts', eligibility, count(*) from pf
  where eligibility='data_conflict' group by all""",
    "profile_arrays": _R
    + f""" select variant_id, count(*) as row_count,
 {_joined('assertion_id','assertion_id')} as assertion_ids,
 {_joined('term','assertion_id')} as source_terms,
 {_joined('route','assertion_id')} as source_term_routes,
 {_joined('assertion_level','assertion_id')} as assertion_levels,
 {_joined('classification_type','assertion_id')} as classification_types,
 {_joined("source_accession||'.'||accession_version",'assertion_id')} as source_accessions,
 {_joined('review_level','assertion_id')} as source_review_levels,
 {_joined('record_status','assertion_id')} as source_record_statuses,
 {_joined("coalesce(cast(date_last_evaluated as varchar),'unknown')",'assertion_id')}
   as date_last_evaluated,
 {_joined('age_days','assertion_id')} as evidence_age_days,
 coalesce(string_agg(distinct case when assertion_level='source_submitted'
   and classification_type='germline' then term end, '|' order by
   case when assertion_level='source_submitted' and classification_type='germline' then term end),'')
   as submission_term_diversity,
 case when bool_or(age_days is null) then 'date_last_evaluated' else '' end as missing_indicators
from routed group by variant_id""",
}

_MEMBERS = """
mt as (select distinct variant_id, representation_id from links where outcome='matched'),
ms as (select mt.variant_id, a.*, source_accession||'.'||accession_version as logical_key,
   cast(case when assertion_level='source_submitted' then substr(source_accession,4) end as bigint) as o from mt join assertions a using (representation_id)),
cn as (select distinct variant_id, 'cond-'||replace(submitter_name,' ','-') as cid from ms where assertion_level='source_submitted'
  union select variant_id, 'cond-shared' from ms where assertion_level='source_submitted' and o%3=0)
"""
ORACLE["profile_evidence"] = _L.replace(ctes("representations", "variants"), ctes("representations", "variants", "assertions")) + "," + _MEMBERS + """
 select m.variant_id, (select string_agg(representation_id,'|' order by representation_id) from mt where mt.variant_id=m.variant_id) as representation_ids,
  coalesce(string_agg(assertion_id,'|' order by assertion_id),'') as assertion_ids,
  coalesce(string_agg(assertion_id,'|' order by assertion_id) filter (assertion_level='source_submitted'),'') as scv_assertion_ids,
  coalesce(string_agg(assertion_id,'|' order by assertion_id) filter (assertion_level<>'source_submitted'),'') as vcv_assertion_ids,
  coalesce(string_agg(logical_key,'|' order by assertion_id) filter (assertion_id is not null),'') as logical_source_keys,
  coalesce(string_agg(submitter_name,'|' order by assertion_id),'') as submitters,
  coalesce((select string_agg(cid,'|' order by cid) from cn where cn.variant_id=m.variant_id),'') as condition_ids,
  coalesce((select string_agg('condition of '||substr(cid,6),'|' order by cid) from cn where cn.variant_id=m.variant_id),'') as condition_names
 from (select distinct variant_id from mt) m left join ms using (variant_id) group by m.variant_id"""
_GENOTYPES = ", gm as (select c.* from sample_calls c where alt_count is not null and variant_id in (select variant_id from summary))"
ORACLE["profile_genotypes"] = _P + _GENOTYPES + """
 select sample_id, variant_id, count(*) as genotype_count, string_agg(genotype_id,'|' order by genotype_id, observation_reference) as genotype_ids,
  string_agg(observation_reference,'|' order by genotype_id, observation_reference) as observation_references,
  string_agg(cast(ploidy as varchar),'|' order by genotype_id, observation_reference, ploidy) as ploidies,
  string_agg(cast(alt_count as varchar),'|' order by genotype_id, observation_reference, ploidy, alt_count) as alt_allele_counts
 from gm group by all"""
ORACLE["rationale_genotypes"] = _P + _GENOTYPES + ORACLE["rationales"][len(_P):].split("select 'rationale-'", 1)[0].rstrip() + """,
 rt as (select 'rationale-'||sha256(concat_ws(chr(31),candidate_id,code)) as rationale_id, sample_id, variant_id from e)
 select rationale_id, genotype_id, observation_reference from rt join gm using (sample_id, variant_id)"""
ORACLE["review_report"] = (
    _P + "," + _MEMBERS
    + """, kx as (select variant_id, string_agg(logical_key, ', ' order by first_id) as records from (
   select variant_id, logical_key, min(assertion_id) as first_id from ms group by all) group by 1),
 cx as (select variant_id, string_agg('condition of '||substr(cid,6), ', ' order by cid) as names from cn group by 1),
"""
    + ORACLE["rationales"][len(_P):].split("select 'rationale-'", 1)[0].strip().lstrip(",")
    + """,
 rs as (select candidate_id, string_agg(code, ', ' order by code) as reasons from (select distinct candidate_id, code from e) group by 1),
 q as (select pf.*, row_number() over (partition by sample_id order by list_position(['review_first','review_next',
   'context_only','not_prioritized','not_eligible'], band), review_order, conflict_order, missing_order, age_order, profile_id) as n from pf),
 ent as (select sample_id, n, [n||'. '||variant_id, '   band: '||band, '   calls: '||genotype_state, '   records: '||coalesce(records,'none'),
   '   conditions: '||coalesce(names,'none given'), '   source disagrees: '||case when source_conflict then 'yes' else 'no' end,
   '   because: '||coalesce(reasons,'none')] as ls
  from q left join kx using (variant_id) left join cx using (variant_id) left join rs using (candidate_id))
 select sample_id, 3+(n-1)*7+i-1 as ordinal, ls[i] as line from ent, range(1,8) t(i)
 union all select sample_id, i-1, (['REVIEW '||sample_id, '__SCOPE__', '__OPEN__'])[i] from (select distinct sample_id from q), range(1,4) t(i)"""
).replace("__SCOPE__", reports.REVIEW_SCOPE).replace("__OPEN__", "Not looked at: " + ", ".join(vocab.UNRESOLVED_ASSESSMENTS))
