"""Registered quality-control queries and their SQL counterparts."""

from pyspark.sql import functions as F

from varloom.operators import qc
from varloom.plans.driver_views import ctes, observations

_CALLED = "upper(raw_genotype) not in ('--','','NC','NOCALL')"
_KNOWN = (
    "upper(source_chromosome) in ("
    + ",".join(f"'{c}'" for c in [*map(str, range(1, 23)), "X", "Y", "MT", "M", "XY"])
    + ")"
)


def call_rate_by_chromosome(spark, sf_dir):
    return (
        qc.chromosome_qc(observations(spark, sf_dir, numbered_lines=False))
        .withColumn("call_rate", F.round("call_rate", 6))
    )


def assay_qc(spark, sf_dir):
    out = qc.assay_qc(observations(spark, sf_dir))
    return out.withColumn("call_rate", F.round("call_rate", 6))


def duplicate_markers(spark, sf_dir):
    records = qc.record_groups(observations(spark, sf_dir, numbered_lines=False))
    return qc.marker_groups(records).where("n > 1").select(
        "sample_id", "source_marker_id", (F.col("n") - 1).alias("extra_records"), "distinct_records"
    )


def duplicate_coordinates(spark, sf_dir):
    records = qc.record_groups(observations(spark, sf_dir, numbered_lines=False))
    return qc.coordinate_groups(records).where("n > 1").select(
        "sample_id", "source_chromosome", "source_position", (F.col("n") - 1).alias("extra_records")
    )


def conflicting_markers(spark, sf_dir):
    records = qc.record_groups(observations(spark, sf_dir, numbered_lines=False))
    return qc.marker_groups(records).where("distinct_records > 1").select(
        "sample_id", "source_marker_id", (F.col("n") - 1).alias("conflicting_records")
    )


def out_of_order_records(spark, sf_dir):
    return qc.out_of_order(observations(spark, sf_dir))


def qc_findings(spark, sf_dir):
    return qc.findings(observations(spark, sf_dir))


def qc_finding_lines(spark, sf_dir):
    return qc.finding_lines(observations(spark, sf_dir))


def qc_related_lines(spark, sf_dir):
    out = qc.related_lines(observations(spark, sf_dir))
    return out.withColumn(
        "related_source_line_numbers", F.array_join("related_source_line_numbers", ",")
    )


QUERIES = {
    f.__name__: f
    for f in (
        call_rate_by_chromosome,
        assay_qc,
        duplicate_markers,
        duplicate_coordinates,
        conflicting_markers,
        out_of_order_records,
        qc_findings,
        qc_finding_lines,
        qc_related_lines,
    )
}

_LAG = """select sample_id, source_chromosome, source_line_number, source_position,
  lag(source_position) over (partition by sample_id, source_chromosome
    order by source_line_number) as previous_position from numbered_calls"""
_REC = "sample_id, source_marker_id, source_chromosome, source_position, raw_genotype"
_GROUPS = f"""
records as (select {_REC}, count(*) as n, min(source_line_number) as first_line,
    max(source_line_number) as last_line from numbered_calls group by all),
groups as (
  select sample_id, 'CONFLICTING_DUPLICATE_MARKER' as code, source_marker_id,
    cast(null as varchar) as source_chromosome, cast(null as varchar) as source_position,
    cast(null as varchar) as raw_genotype, sum(n) as related_line_count,
    min(first_line) as first_line, max(last_line) as last_line
  from records group by sample_id, source_marker_id having count(*) > 1
  union all select sample_id, 'DUPLICATE_MARKER_ID', source_marker_id, null, null, null, sum(n),
    min(first_line), max(last_line)
  from records group by sample_id, source_marker_id having sum(n) > 1
  union all select sample_id, 'DUPLICATE_COORDINATE', null, source_chromosome,
    cast(source_position as varchar), null, sum(n), min(first_line), max(last_line)
  from records group by sample_id, source_chromosome, source_position having sum(n) > 1
  union all select sample_id, 'EXACT_DUPLICATE_RECORD', source_marker_id, source_chromosome,
    cast(source_position as varchar), raw_genotype, n, first_line, last_line
  from records where n > 1)
"""

_FINDING_LINES = f""",
{_GROUPS}
select g.sample_id, g.code, g.source_marker_id, g.source_chromosome, g.source_position,
  g.raw_genotype, c.source_line_number
from groups g join numbered_calls c on c.sample_id=g.sample_id
  and (g.source_marker_id is null or g.source_marker_id=c.source_marker_id)
  and (g.source_chromosome is null or (g.source_chromosome=c.source_chromosome
    and g.source_position=cast(c.source_position as varchar)))
  and (g.raw_genotype is null or g.raw_genotype=c.raw_genotype)"""

ORACLE = {
    "call_rate_by_chromosome": ctes("calls")
    + f"""
select sample_id, source_chromosome, count(*) as record_count,
  count(*) filter ({_CALLED}) as called_count,
  count(*) filter (not ({_CALLED})) as no_call_count,
  min(source_position) as min_source_position, max(source_position) as max_source_position,
  round(count(*) filter ({_CALLED}) / count(*), 6) as call_rate
from calls group by sample_id, source_chromosome""",
    "assay_qc": ctes("numbered_calls")
    + f""",
base as (select *, {_CALLED} as called, length(raw_genotype) as w,
  regexp_full_match(raw_genotype, '[ACGT]{{2}}') as two from numbered_calls),
lagged as ({_LAG}),
recs as (select {_REC}, count(*) n from base group by all),
marks as (select sample_id, sum(n) n, count(*) d from recs group by sample_id, source_marker_id),
places as (select sample_id, sum(n) n from recs
  group by sample_id, source_chromosome, source_position)
select b.sample_id, count(*) as parsed_record_count, count(*) filter (called) as called_record_count,
  count(*) filter (not called) as no_call_record_count,
  count(*) filter (two) as conventional_two_acgt_allele_calls,
  count(*) filter (two and raw_genotype[1]=raw_genotype[2]) as lexical_homozygous_acgt_calls,
  count(*) filter (two and raw_genotype[1]<>raw_genotype[2]) as lexical_heterozygous_acgt_calls,
  count(*) filter (called and w=1) as single_allele_tokens,
  count(*) filter (called and w>2) as other_called_tokens,
  count(*) filter (not {_KNOWN}) as unrecognized_chromosome_token_count,
  any_value(m.a) as duplicate_marker_id_count, any_value(pl.a) as duplicate_coordinate_count,
  any_value(r.a) as exact_duplicate_record_count,
  any_value(m.c) as conflicting_duplicate_marker_count,
  coalesce(any_value(o.a),0) as out_of_order_record_count,
  0 as malformed_record_count, 0 as invalid_position_count,
  round(count(*) filter (called)/count(*),6) as call_rate
from base b
join (select sample_id, sum(n-1) a, sum(case when d>1 then n-1 else 0 end) c from marks group by 1) m
  on m.sample_id=b.sample_id
join (select sample_id, sum(n-1) a from places group by 1) pl on pl.sample_id=b.sample_id
join (select sample_id, sum(n-1) a from recs group by 1) r on r.sample_id=b.sample_id
left join (select sample_id, count(*) a from lagged where source_position<previous_position
  group by 1) o on o.sample_id=b.sample_id
group by b.sample_id""",
    "duplicate_markers": ctes("calls")
    + """
select sample_id, source_marker_id, count(*)-1 as extra_records,
  count(distinct (source_chromosome, source_position, raw_genotype)) as distinct_records
from calls group by sample_id, source_marker_id having count(*)>1""",
    "duplicate_coordinates": ctes("calls")
    + """
select sample_id, source_chromosome, source_position, count(*)-1 as extra_records
from calls group by all having count(*)>1""",
    "conflicting_markers": ctes("calls")
    + """
select sample_id, source_marker_id, count(*)-1 as conflicting_records
from calls group by sample_id, source_marker_id
having count(distinct (source_chromosome, source_position, raw_genotype))>1""",
    "out_of_order_records": ctes("numbered_calls")
    + f" select * from ({_LAG}) where source_position < previous_position",
    "qc_findings": ctes("numbered_calls")
    + f""",
{_GROUPS},
single as (select sample_id, 'OUT_OF_ORDER_RECORD' as code, source_line_number from ({_LAG})
    where source_position < previous_position
  union all select sample_id, 'UNRECOGNIZED_CHROMOSOME_TOKEN', source_line_number
    from numbered_calls where not {_KNOWN})
select sample_id, code, null::bigint as source_line_number, source_marker_id, source_chromosome,
  source_position, raw_genotype, related_line_count, first_line, last_line, 'warning' as severity,
  case code when 'CONFLICTING_DUPLICATE_MARKER'
      then 'Records of marker ' || source_marker_id || ' contradict each other.'
    when 'DUPLICATE_MARKER_ID' then 'Marker ' || source_marker_id || ' stands on several lines.'
    when 'DUPLICATE_COORDINATE' then 'Several records share this chromosome and position.'
    else 'Several lines repeat this record unchanged.' end as message
from groups
union all select sample_id, code, source_line_number, null, null, null, null, 0, null, null,
  case code when 'OUT_OF_ORDER_RECORD' then 'info' else 'warning' end,
  case code when 'OUT_OF_ORDER_RECORD'
    then 'The position is lower than that of the record before it on this chromosome.'
    else 'This chromosome name is not one of the known spellings.' end
from single""",
    "qc_finding_lines": ctes("numbered_calls") + _FINDING_LINES,
    "qc_related_lines": ctes("numbered_calls")
    + f"""
, found as (with base as (select 1){_FINDING_LINES})
select sample_id, code, source_marker_id, source_chromosome, source_position, raw_genotype,
  count(*) as related_source_line_numbers_count,
  string_agg(source_line_number, ',' order by source_line_number) as related_source_line_numbers
from found group by all""",
}
