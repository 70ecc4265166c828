"""Registered normalisation queries and their SQL counterparts."""

from pyspark.sql import functions as F

from varloom.functions.ids import content_key, stable_id
from varloom.operators import normalize as nz
from varloom.plans.driver_views import TILE, ctes, observations, view


def resolved_markers(spark, sf_dir):
    return nz.resolve_markers(
        view(spark, sf_dir, "marker_defs"),
        view(spark, sf_dir, "ref_tiles"),
        TILE,
        view(spark, sf_dir, "liftover"),
    )


def mapped(spark, sf_dir, numbered_lines=True):
    return nz.map_observations(
        observations(spark, sf_dir, numbered_lines), resolved_markers(spark, sf_dir)
    )


def reference_validation(spark, sf_dir):
    return resolved_markers(spark, sf_dir).select(
        "marker_id", "source_assembly", "build_count", "outcome", "reason", "strand_transform",
        "liftover_status", "reference_validation", "target_chromosome", "target_position",
        "variant_id", "candidate_count",
    )


def normalize_mappings(spark, sf_dir):
    return nz.mapping_rows(mapped(spark, sf_dir)).select(
        "observation_reference", "sample_id", "source_line_number", "outcome", "reason",
        "resolved_source_assembly", "target_chromosome", "target_position", "variant_id",
        "strand_transform", "liftover_required", "liftover_status", "reference_validation",
        "candidate_count",
        F.array_join("source_to_canonical_alleles", "/").alias("alleles"),
    )


def normalization_qc(spark, sf_dir):
    return nz.normalization_qc(mapped(spark, sf_dir, numbered_lines=False))


def canonical_genotypes(spark, sf_dir):
    return nz.canonical_genotypes(mapped(spark, sf_dir)).select(
        "genotype_id", "observation_reference", "sample_id", "variant_id", "ploidy", "alt_count",
        "chromosome", "position", F.array_join("alleles", "/").alias("alleles"),
    )


def canonical_variants(spark, sf_dir):
    return nz.variants(resolved_markers(spark, sf_dir))


def liftover_candidates(spark, sf_dir):
    resolved = resolved_markers(spark, sf_dir)
    candidates = nz.marker_candidates(
        view(spark, sf_dir, "marker_defs"), resolved, view(spark, sf_dir, "liftover")
    )
    rows = nz.map_observations(observations(spark, sf_dir), resolved)
    return nz.mapping_candidates(rows, candidates).drop("normalization_run_id")


def stable_ids(spark, sf_dir):
    rows = observations(spark, sf_dir)
    return rows.select(
        "sample_id", "source_line_number", nz.observation_reference().alias("observation_reference")
    )


QUERIES = {
    f.__name__: f
    for f in (
        reference_validation,
        normalize_mappings,
        normalization_qc,
        canonical_genotypes,
        canonical_variants,
        liftover_candidates,
        stable_ids,
    )
}

_OBS_ID = (
    "'obs-' || sha256(concat_ws(chr(31), 'run-' || s, source_line_number, sample_id, "
    "source_marker_id, source_chromosome, source_position, raw_genotype))"
)
# Row-at-a-time restatement of the cascade with correlated lookups.
_MARK = """
defs as (select marker_id, case when assembly in ('hg38') then 'GRCh38' else 'GRCh37' end as build,
   replace(chromosome,'chr','') as chrom, position, reference, alternate, orientation,
   orientation_authoritative as auth, rsid from marker_defs),
ids as (select distinct marker_id from defs),
pairs as (select marker_id, build from ids, (values ('GRCh37'),('GRCh38')) t(build)),
cnt as (select marker_id, build, count(*) n from defs group by all),
uni as (select d.* from defs d join cnt using (marker_id, build) where n=1),
lift as (select chromosome c, pos0, count(*) n, min(cand_chromosome) tc, min(cand_pos0)+1 tp
   from liftover group by all),
j as (select p.marker_id, p.build, coalesce(c.n,0) n, u.* exclude (marker_id, build), l.n ln, l.tc, l.tp
  from pairs p left join cnt c using (marker_id, build) left join uni u using (marker_id, build)
  left join lift l on p.build<>'GRCh38' and l.c=u.chrom and l.pos0=u.position-1),
k as (select *, case when n=0 then 'MARKER_DEFINITION_ASSEMBLY_MISMATCH'
    when n>1 then 'MARKER_DEFINITION_CONFLICT'
    when length(reference)<>length(alternate) then 'UNSUPPORTED_ALLELE_REPRESENTATION'
    when not auth then case when reference||alternate in ('AT','TA','CG','GC')
      then 'PALINDROMIC_AMBIGUITY' else 'STRAND_UNRESOLVED' end end as early from j),
m as (select *, case when early is not null or build='GRCh38' then 'not_required'
    when ln is null then 'failed' when ln>1 then 'ambiguous' else 'success' end as ls from k),
q as (select *, case when early is not null then null when build='GRCh38' then chrom
      when ls='success' then tc end as fc,
    case when early is not null then null when build='GRCh38' then position
      when ls='success' then tp end as fp from m),
r as (select q.*, case when fp is null then 'not_attempted'
     when substr(t.bases, cast((fp-1)%10+1 as int), length(reference))=reference then 'match'
     else 'mismatch' end as rv
   from q left join ref_tiles t on t.contig=q.fc and t.tile=(fp-1-(fp-1)%10)/10),
res as (select *, coalesce(early, case ls when 'failed' then 'NO_LIFTOVER_CANDIDATE'
     when 'ambiguous' then 'MULTIPLE_LIFTOVER_CANDIDATES'
     else case when rv='mismatch' then 'TARGET_REF_MISMATCH' end end) as reason from r),
marks as (select marker_id, build as source_assembly, n as build_count,
  case when reason is null then 'mapped' when reason in
     ('MARKER_DEFINITION_ASSEMBLY_MISMATCH','UNSUPPORTED_ALLELE_REPRESENTATION') then 'unsupported'
     when reason='TARGET_REF_MISMATCH' then 'failed' when reason='NO_LIFTOVER_CANDIDATE'
     then 'unmapped' else 'ambiguous' end as outcome, reason,
  coalesce(orientation,'unknown') as strand_transform, ls as liftover_status,
  rv as reference_validation, fc as target_chromosome, fp as target_position, reference, alternate,
  rsid, case when reason is null then 'var-'||sha256(concat_ws(chr(31),'GRCh38',fc,fp,reference,alternate))
    end as variant_id,
  case when reason='MARKER_DEFINITION_CONFLICT' then n when reason in
    ('PALINDROMIC_AMBIGUITY','STRAND_UNRESOLVED') then 1 when ls in ('success','ambiguous')
    then ln else 0 end as candidate_count from res)
"""
_BUILD = "case source_build when 'hg19' then 'GRCh37' when 'GRCh38' then 'GRCh38' end"


def mapped_sql(calls):
    return f"""
mapped as (select c.*, {_BUILD} as resolved_source_assembly,
  coalesce(outcome,'unmapped') as outcome,
  case when {_BUILD} is null then 'MISSING_OR_UNKNOWN_BUILD'
    when outcome is null then 'MARKER_DEFINITION_ABSENT' else reason end as reason,
  target_chromosome, target_position, variant_id, reference, alternate,
  coalesce(strand_transform,'unknown') as strand_transform,
  coalesce({_BUILD}<>'GRCh38', false) as liftover_required,
  coalesce(liftover_status,'not_required') as liftover_status,
  coalesce(reference_validation,'not_attempted') as reference_validation,
  coalesce(candidate_count,0) as candidate_count,
  case when outcome='mapped' and upper(raw_genotype) not in ('--','') and length(raw_genotype)<=2 then
    case when strand_transform in ('complement','reverse_complement')
      then translate(raw_genotype,'ACGT','TGCA') else raw_genotype end end as canon
from {calls} c left join marks k on k.marker_id=c.source_marker_id and k.source_assembly={_BUILD})
"""


MARKERS_SQL = _MARK
_NUM = ctes("numbered_calls", "marker_defs", "ref_tiles", "liftover") + "," + _MARK
_ALLELES = "case when length(canon)=1 then canon else canon[1]||'/'||canon[2] end"

ORACLE = {
    "reference_validation": ctes("marker_defs", "ref_tiles", "liftover")
    + ","
    + _MARK
    + """select marker_id, source_assembly, build_count, outcome, reason, strand_transform,
 liftover_status, reference_validation, target_chromosome, target_position, variant_id,
 candidate_count from marks""",
    "normalize_mappings": _NUM
    + ","
    + mapped_sql("numbered_calls")
    + f"""select {_OBS_ID} as observation_reference, sample_id, source_line_number, outcome, reason,
 resolved_source_assembly, target_chromosome, target_position, variant_id, strand_transform,
 liftover_required, liftover_status, reference_validation, candidate_count,
 coalesce({_ALLELES},'') as alleles from mapped""",
    "normalization_qc": ctes("calls", "marker_defs", "ref_tiles", "liftover")
    + ","
    + _MARK
    + ","
    + mapped_sql("calls")
    + """, d as (
 select 'outcomes' as dimension, outcome as value from mapped
 union all select 'reasons', reason from mapped
 union all select 'strand_transformations', strand_transform from mapped
 union all select 'liftover', liftover_status from mapped
 union all select 'reference_validation', reference_validation from mapped
 union all select 'source_chromosomes', source_chromosome from mapped
 union all select 'call_state', case when raw_genotype='--' then 'no_call' else 'called' end from mapped)
select dimension, value, count(*) as n from d where value is not null group by all""",
    "canonical_genotypes": _NUM
    + ","
    + mapped_sql("numbered_calls")
    + f""", g as (select *, {_OBS_ID} as obs, {_ALLELES} as a from mapped where canon is not null
   and canon[1] in (reference,alternate) and canon[-1] in (reference,alternate))
select 'gt-'||sha256(concat_ws(chr(31),obs,variant_id,a)) as genotype_id,
 obs as observation_reference, sample_id, variant_id, length(canon) as ploidy,
 length(canon)-length(replace(canon,alternate,'')) as alt_count,
 target_chromosome as chromosome, target_position as position, a as alleles from g""",
    "canonical_variants": ctes("marker_defs", "ref_tiles", "liftover")
    + ","
    + _MARK
    + """select variant_id, 'GRCh38' as assembly, target_chromosome as chromosome,
 target_position as position, reference, alternate, min(rsid) as rsid from marks
where outcome='mapped' group by all""",
    "liftover_candidates": _NUM
    + ","
    + mapped_sql("numbered_calls")
    + f""", o as (select *, {_OBS_ID} as obs from mapped),
c as (select obs, sample_id, source_marker_id, d.chrom, d.position,
    reference_alt as detail
  from o join (select *, concat_ws('/',reference,alternate,orientation) as reference_alt from defs) d
   on d.marker_id=o.source_marker_id and d.build=o.resolved_source_assembly
  where reason in ('MARKER_DEFINITION_CONFLICT','PALINDROMIC_AMBIGUITY','STRAND_UNRESOLVED')
  union all
  select obs, sample_id, source_marker_id, l.cand_chromosome, l.cand_pos0+1, 'liftover'
  from o join defs d on d.marker_id=o.source_marker_id and d.build=o.resolved_source_assembly
   join liftover l on l.chromosome=d.chrom and l.pos0=d.position-1
  where liftover_status in ('success','ambiguous'))
select 'cand-'||sha256(concat_ws(chr(31),obs,chrom,position,detail)) as candidate_id,
 obs as observation_reference, sample_id, source_marker_id, chrom as chromosome, position from c""",
    "stable_ids": ctes("numbered_calls")
    + f"select sample_id, source_line_number, {_OBS_ID} as observation_reference from numbered_calls",
}
