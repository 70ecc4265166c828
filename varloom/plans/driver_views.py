"""Genotype-shaped views over the star-schema tables.

Each view is one portable SQL text used by Spark (table placeholders bound to
DataFrames) and by the DuckDB check (placeholders replaced by table names).
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from varloom.operators.scale import numbered

_REF = "substr('ACGT', cast(1 + {k}%4 as int), 1)"
_ALT = "substr('ACGT', cast(1 + ({k}+1+{k}%3)%4 as int), 1)"
_CHROM = "case when {k}%22=0 then 'X' else cast({k}%22 as string) end"


def _ref(k):
    return _REF.replace("{k}", k)


def _alt(k):
    return _ALT.replace("{k}", k)


def _chrom(k):
    return _CHROM.replace("{k}", k)


def _third(k):
    """The base after ALT in ACGT order that is neither REF nor ALT."""
    return (
        f"substr('ACGT', cast(1 + ({k}+1+{k}%3 + case when {k}%3=2 then 2 else 1 end)%4 as int), 1)"
    )


LINE_ORDER = (
    "l_orderkey,l_linenumber,l_partkey,l_quantity,l_extendedprice,l_discount,l_tax,l_shipdate"
)


def _calls(more: str = "") -> str:
    """The calls of line items; ``more``: further columns of the line items, each behind a comma."""
    return f"""
select sample_id, s, source_marker_id, source_chromosome, source_position, p, ref, alt, token,
  case when p%9 in (5,7) then translate(token,'ACGT','TGCA') else token end as raw_genotype,
  case when s%5=0 then 'hg19' when s%7=3 then 'UNKNOWN' else 'GRCh38' end as source_build,
  {LINE_ORDER}{more}
from (select 'subject-' || lpad(cast(l_suppkey as string),10,'0') as sample_id, l_suppkey as s,
    'rs' || cast(l_partkey as string) as source_marker_id,
    case when l_partkey%53=9 then 'contig_9' else {_chrom("l_partkey")} end as source_chromosome,
    1000+10*l_partkey as source_position, l_partkey as p, ref, alt, {LINE_ORDER}{more},
    case (l_orderkey+l_linenumber)%16 when 0 then '--' when 1 then ref when 2 then 'DEL'
      when 3 then ref||ref when 4 then ref||ref when 5 then ref||ref when 6 then ref||ref
      when 7 then ref||ref when 8 then ref||alt when 9 then ref||alt when 10 then alt||ref
      when 11 then ref||alt when 12 then ref||alt else alt||alt end as token
  from (select *, {_ref("l_partkey")} as ref, {_alt("l_partkey")} as alt from {{lineitem}}) a) b
"""


# One assay call per line item: sample = supplier, marker = part.
CALLS = _calls()

# The same calls with the physical line number inside the sample's source file.
NUMBERED_CALLS = f"""
select *, row_number() over (partition by sample_id order by {LINE_ORDER}) as source_line_number
from ({CALLS}) c
"""

# Canonical genotypes (one- and two-letter tokens, already on the canonical strand).
# Markers with p%41=7 read their ALT as a third base, i.e. an allele outside REF/ALT.
GENOTYPES = f"""
select sample_id, s, p, variant_id, 'GRCh38' as assembly, chromosome, position, reference, alternate,
  case when k=1 then reference when k<8 then reference||reference when k=10 then seen||reference
    when k<13 then reference||seen else seen||seen end as pair,
  case when k=1 then 1 else 2 end as ploidy,
  case when p%41=7 or k<8 then 0 when k<13 then 1 else 2 end as alt_count,
  case when p%41<>7 or k<8 then '' when k<13 then seen else seen||seen end as foreign_bases
from (select 'subject-' || lpad(cast(l_suppkey as string),10,'0') as sample_id, l_suppkey as s,
    l_partkey as p, 'var-' || cast(l_partkey as string) as variant_id,
    {_chrom("l_partkey")} as chromosome, 1000+10*l_partkey as position,
    {_ref("l_partkey")} as reference, {_alt("l_partkey")} as alternate,
    case when l_partkey%41=7 then {_third("l_partkey")} else {_alt("l_partkey")} end as seen,
    (l_orderkey+l_linenumber)%16 as k
  from {{lineitem}} where (l_orderkey+l_linenumber)%16 not in (0,2)) a
"""

PARTS = f"""
select p_partkey as p, p_brand, p_type, p_size, 'rs' || cast(p_partkey as string) as marker_id,
  {_chrom("p_partkey")} as chromosome, 1000+10*p_partkey as position,
  {_ref("p_partkey")} as ref, {_alt("p_partkey")} as alt,
  substr('ACGT', cast(1 + (p_partkey+1+(p_partkey+1)%3)%4 as int), 1) as alt2
from {{part}}
"""

MARKER_DEFS = f"""
select marker_id, assembly, chromosome, position, reference, alternate, orientation,
  orientation_authoritative, rsid
from (
  select marker_id, case when p%50 in (1,7) then 'GRCh37' else 'hg38' end as assembly,
    'chr' || chromosome as chromosome, position, ref as reference,
    case when p%23=3 then alt||ref else alt end as alternate,
    case when p%9=5 then 'complement' when p%9=7 then 'reverse_complement' else 'none' end
      as orientation, p%11<>4 as orientation_authoritative, marker_id as rsid
  from ({PARTS}) a where p%37<>8
  union all
  select marker_id, case when p%50 in (1,7) then 'GRCh37' else 'hg38' end, chromosome, position,
    ref, alt2, 'none', true, marker_id from ({PARTS}) b where p%17=2 and p%37<>8
  union all
  select marker_id, '37', chromosome, position, ref, alt,
    case when p%9 in (5,7) then 'complement' else 'none' end, true, marker_id
  from ({PARTS}) c where p%2=0 and p%50 not in (1,7) and p%37<>8
) d
"""

TILE = 10
REF_TILES = f"""
select chromosome as contig, 99+p as tile,
  lpad(case when p%29=6 then alt else ref end, {TILE}, 'N') as bases from ({PARTS}) a
"""

LIFTOVER = f"""
select chromosome, position-1 as pos0, chromosome as cand_chromosome, position-1 as cand_pos0
from ({PARTS}) a where p%3<>0
union all
select chromosome, position-1, chromosome, position+9 from ({PARTS}) b where p%3=2
"""

# All calls with the canonical variant they are about; no usable allele -> NULL counts.
SAMPLE_CALLS = """
select sample_id, s, p, 'var-' || cast(p as string) as variant_id,
  case when k in (0,2) then null when k=1 then 1 else 2 end as ploidy,
  case when k in (0,2) then null when k<8 then 0 when k<13 then 1 else 2 end as alt_count,
  'gt-' || cast(o as string) || '-' || cast(n as string) as genotype_id, 'line-' || cast(o as string) || '-' || cast(n as string)
    as observation_reference
from (select l_orderkey as o, l_linenumber as n, 'subject-' || lpad(cast(l_suppkey as string),10,'0') as sample_id, l_suppkey as s,
    l_partkey as p, (l_orderkey+l_linenumber)%16 as k from {lineitem}) a
"""

VARIANTS = f"""
select 'var-' || cast(p as string) as variant_id, 'GRCh38' as assembly, chromosome, position,
  ref as reference, alt as alternate, p from ({PARTS}) a where p%31<>5
union all
select 'var-dup-' || cast(p as string), 'GRCh38', chromosome, position, ref, alt, p
from ({PARTS}) b where p%31=4
"""

REPRESENTATIONS = f"""
select 'rep-' || cast(p as string) as representation_id,
  'VCV' || lpad(cast(p as string),9,'0') as vcv_accession, 1+p%4 as vcv_version, p,
  case when p%31=1 then 'Haplotype' else 'SimpleAllele' end as variation_type,
  case when p%31=2 then 'GRCh37' else 'GRCh38' end as assembly, chromosome, position,
  ref as reference, case when p%31=3 then null else alt end as alternate from ({PARTS}) a
"""

# External assertions: one submitted record per order, about the variant of its customer key,
# and one source-computed aggregate per part.
ASSERTIONS = """
select 'rep-' || cast(p as string) as representation_id, p,
  'as-' || lpad(cast(o_orderkey as string),12,'0') as assertion_id,
  'SCV' || lpad(cast(o_orderkey as string),12,'0') as source_accession,
  1 + o_orderkey%3 as accession_version, 'source_submitted' as assertion_level,
  case when p%7=0 then 'somatic_clinical_impact' else 'germline' end as classification_type,
  case term_index when 0 then 'Pathogenic' when 1 then 'Benign' when 2 then ' benign '
    when 3 then 'Uncertain  significance' when 4 then 'Likely benign' else 'novel term' end as term,
  case o_orderstatus when 'O' then 'current' when 'F' then 'replaced' else null end as status_term,
  case o_orderkey%6 when 0 then 'practice guideline' when 1 then 'reviewed by expert panel'
    when 2 then 'criteria provided, multiple submitters, no conflicts'
    when 3 then 'Criteria  provided, single submitter' when 4 then 'no assertion criteria provided'
    else null end as review_status,
  case when o_orderkey%10=7 then null else cast(o_orderdate as date) end as date_last_evaluated,
  'lab ' || cast(o_custkey%17 as string) as submitter_name
from (select *, (p%6 + case when o_orderkey%8=0 then 1 else 0 end)%6 as term_index
  from (select *, o_custkey as p from {orders}) x) y
union all
select 'rep-' || cast(p_partkey as string), p_partkey,
  'av-' || lpad(cast(p_partkey as string),12,'0'),
  'VCV' || lpad(cast(p_partkey as string),9,'0'), 1+p_partkey%4, 'source_computed_aggregate',
  case when p_partkey%7=0 then 'oncogenicity' else 'germline' end,
  case when p_partkey%13=4 then 'Conflicting classifications of pathogenicity'
    when p_partkey%6=3 then 'Uncertain significance' when p_partkey%6=0 then 'Pathogenic'
    else 'Benign' end,
  case when p_partkey%13=4 then 'replaced' else 'Current record' end,
  'criteria provided, single submitter', cast('2001-06-15' as date), null
from {part} where p_partkey%5<>0
"""

RELEASE_DATE = "2003-01-01"

# Score models: two neighbouring autosomal parts form one model.
PGS_VARIANTS = f"""
select 'PGS' || lpad(cast(p-p%2 as string),9,'0') as pgs_id, p, 'var-' || cast(p as string) as variant_id,
  'GRCh38' as assembly, chromosome, position, ref as reference, alt as alternate,
  case when p%4<2 then ref else alt end as effect_allele,
  case when p%97=13 then 'unknown' when p%97=14 then concat('0.', cast(100+p%900 as string), '45678901234567891')
   when p%97=15 then '60000000000000000000'
   when p%22 in (6,7) then concat(case when p%66=6 then '-' else '' end, '4', lpad(cast(cast(p as bigint)*7919 as string),19,'9'), '.',
     lpad(cast((cast(p as bigint)*1000003)%1000000000 as string),9,'0'), lpad(cast((cast(p as bigint)*777767)%1000000000 as string),9,'0'))
   when p%11=3 then concat(case when p%2=1 then '-' else '' end, cast(p%3 as string), '.',
     lpad(cast((cast(p as bigint)*1000003)%1000000000 as string),9,'0'), lpad(cast((cast(p as bigint)*777767)%1000000000 as string),9,'0'))
   when p%11=5 then concat(case when p%2=0 then '-' else '' end, '0.0000000', lpad(cast(p as string),11,'0'))
   else cast(cast(cast(p%2001-1000 as decimal(9,3))/1000 as decimal(9,3)) as string) end as effect_weight from ({PARTS}) a
where chromosome <> 'X'
"""
PGS_MODELS = f"""
select pgs_id, min(p) as key, case when min(p)%10=4 then '2' else '1' end as model_version,
  count(*) + case when min(p)%26=8 then 1 else 0 end as declared_variant_count,
  case when min(p)%14=2 then 'partial_allowed' else 'all_supported_variants_required' end
    as completeness_policy from ({PGS_VARIANTS}) v group by pgs_id
"""
PGS_REQUESTS = f"""
select distinct sample_id, 'PGS' || lpad(cast(p-p%2 as string),9,'0') as pgs_id
from ({CALLS}) c where source_chromosome <> 'X'
"""
PGS_REFERENCE = """
select 'PGS' || lpad(cast(o_custkey-o_custkey%2 as string),9,'0') as pgs_id, '1' as model_version,
  cast(o_orderkey%4001-2000 as double)/1000 as score from {orders} where (o_custkey-o_custkey%2)%22<>6
"""

# Pharmacogenes: three neighbouring parts form one gene.
PGX_GENES = f"""
select distinct 'G' || lpad(cast(p-p%3 as string),9,'0') as gene_id, p-p%3 as g,
  case when (p-p%3)%39=6 then 'external_validated_call_required'
    else 'star_haplotype_small_variant' end as strategy from ({PARTS}) a
"""
PGX_LOCI = f"""
select 'L' || lpad(cast(p as string),9,'0') as locus_id,
  'G' || lpad(cast(p-p%3 as string),9,'0') as gene_id, p, 'var-' || cast(p as string) as variant_id,
  'GRCh38' as assembly, chromosome, position, ref as reference, alt as alternate
from ({PARTS}) a where chromosome <> 'X'
"""
PGX_ALLELES = f"""
select gene_id, g, a, gene_id || '*' || lpad(cast(a as string),3,'0') as allele_id,
  case when a=3 then 'retired' else 'active' end as status, 'src' || cast(g%2 as string) as source_id,
  case when a=2 and g%57=3 then 'v2' else 'v1' end as source_version
from (select gene_id, g, __FIRST__ case when g%291=9 then 135 else 4 end __LAST__ as a
  from ({PGX_GENES}) t) w
"""
PGX_CONSTRAINTS = f"""
select allele_id, locus_id, case when (p+a)%5=0 then 'not_constraining'
    when (a=1 and p%3=0) or (a>=2 and p%3=1) then 'required_alternate'
    else 'required_reference' end as state
from ({PGX_ALLELES}) al join ({PGX_LOCI}) lo on lo.gene_id=al.gene_id where (p+a)%7<>0
"""
PGX_REQUESTS = f"""
select distinct sample_id, 'G' || lpad(cast(p-p%3 as string),9,'0') as gene_id from ({CALLS}) c
"""

# Two projection models over the autosomal parts (even and odd keys), two components each.
PCA_LOADINGS = f"""
select 'pca' || cast(1+p%2 as string) as model_id, 'mv-' || cast(p as string) as model_variant_id, p,
  'var-' || cast(p as string) as variant_id, 'GRCh38' as assembly, chromosome, position,
  ref as reference, alt as alternate, alt as effect_allele,
  cast(p%3 as double)/2 as mean, cast(1 as double) as scale,
  cast(p%7-3 as double) as l1, cast(p%5-2 as double) as l2 from ({PARTS}) a where chromosome <> 'X'
"""
PCA_SCORES = """
select vec_id, 'r' || lpad(cast(vec_id as string),9,'0') as reference_sample_id,
  'g' || cast(label as string) as reference_group_id, embedding from {embeddings}
"""

# Requested markers of a source file and extract rows (BED4+) of two lookup tracks.
SOURCE_MARKERS = f"""
select p, case when p%43=6 then 'i' else 'rs' end || cast(p as string) as marker_id, chromosome,
  position from ({PARTS}) a
"""
BED_ROWS = f"""
select track, p, 'chr' || chromosome as chrom, position-1 as start0, position-1+length(r) as end0,
  name, r as ref, length(alts)-length(replace(alts,',','')) as alt_count, alts
from (
  select case when p%5=0 then 'clinvar' else 'common' end as track, p, chromosome,
    case when p%41=3 then position+3 else position end as position, marker_id as name,
    case when p%53=7 then ref||alt else ref end as r,
    case when p%3=1 then alt||','||alt2||',' else alt||',' end as alts
  from ({PARTS}) a where p%37<>8
  union all
  select 'common', p, chromosome, position, marker_id, ref, alt2||',' from ({PARTS}) b where p%47=5
  union all
  select 'clinvar', p, chromosome, position, marker_id, ref, alt||',' from ({PARTS}) c where p%5=1
) d
"""
TARGET_ROWS = f"""
select 'chr' || chromosome as chrom, position-1 as start0, position as end0, marker_id as name,
  case when p%29=6 then alt else ref end as ref, 1 as alt_count, alt||',' as alts
from ({PARTS}) a where p%3<>0
union all
select 'chr' || chromosome, position+9, position+10, marker_id, ref, 2, alt2||','||alt||','
from ({PARTS}) b where p%3=2
"""

MEMBERS = """
select 'm' || cast(s_suppkey as string) as member_id,
  'subject-' || lpad(cast(s_suppkey as string),10,'0') as subject_id,
  'run-' || cast(s_suppkey as string) as run_id, s_suppkey as s from {supplier}
"""

PARENT_EDGES = """
select 'edge-' || cast(c.s_suppkey as string) || '-' || cast(q.s_suppkey as string) as assertion_id,
  'm' || cast(q.s_suppkey as string) as parent_member_id,
  'm' || cast(c.s_suppkey as string) as child_member_id, c.s_suppkey as child,
  q.s_suppkey as parent
from {supplier} c join (
  select s_suppkey, (s_suppkey-1-(s_suppkey-1)%2)/2 as child_key from {supplier}
  where s_suppkey > 0) q on q.child_key = c.s_suppkey
"""

VIEWS = {
    "calls": CALLS,
    "numbered_calls": NUMBERED_CALLS,
    "genotypes": GENOTYPES,
    "parts": PARTS,
    "marker_defs": MARKER_DEFS,
    "ref_tiles": REF_TILES,
    "liftover": LIFTOVER,
    "assertions": ASSERTIONS,
    "sample_calls": SAMPLE_CALLS,
    "variants": VARIANTS,
    "representations": REPRESENTATIONS,
    "pgs_variants": PGS_VARIANTS,
    "pgs_models": PGS_MODELS,
    "pgs_requests": PGS_REQUESTS,
    "pgs_reference": PGS_REFERENCE,
    "pgx_genes": PGX_GENES,
    "pgx_loci": PGX_LOCI,
    "pgx_alleles": PGX_ALLELES,
    "pgx_constraints": PGX_CONSTRAINTS,
    "pgx_requests": PGX_REQUESTS,
    "pca_loadings": PCA_LOADINGS,
    "pca_scores": PCA_SCORES,
    "source_markers": SOURCE_MARKERS,
    "bed_rows": BED_ROWS,
    "target_rows": TARGET_ROWS,
    "members": MEMBERS,
    "parent_edges": PARENT_EDGES,
}
TABLES = ("lineitem", "part", "orders", "supplier", "embeddings", "customer")


def _counting(text: str, opening: str) -> str:
    """Spell "one row per number below a count", the one construct without a portable form."""
    return text.replace("__FIRST__", opening).replace("__LAST__", ")))")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver view as a DataFrame; line numbers are assigned without per-sample windows."""
    if name == "numbered_calls":
        # numbers are given to the line items as they are: what follows from them is not dealt
        lines = table(spark, sf_dir, "lineitem").select("l_suppkey", *LINE_ORDER.split(","))
        # suppliers whose samples have one name are one sample: a name holds the first ten characters of the key
        first = numbered(
            lines.withColumn("_sample", F.substring(F.col("l_suppkey").cast("string"), 1, 10).cast("bigint")),
            ["_sample"],
            F.floor(F.col("l_orderkey") / 65536),
            [F.col(c) for c in LINE_ORDER.split(",")],
            "source_line_number",
        )
        return spark.sql(_calls(", source_line_number"), lineitem=first.drop("_sample"))
    text = _counting(VIEWS[name], "explode(sequence(0, -1 + (")
    used = {t: table(spark, sf_dir, t) for t in TABLES if "{" + t + "}" in text}
    return spark.sql(text, **used)


def ctes(*names: str) -> str:
    """``WITH`` prefix defining the named views for the DuckDB check."""
    plain = {t: t for t in TABLES}
    return "with " + ",\n".join(f"{n} as ({_counting(VIEWS[n].format(**plain), 'unnest(range(0, (')})" for n in names)


def observations(spark: SparkSession, sf_dir: str, numbered_lines: bool = True) -> DataFrame:
    """Raw observations of the cohort, as the text scan would deliver them."""
    from varloom.functions.tokens import classify

    calls = view(spark, sf_dir, "numbered_calls" if numbered_lines else "calls")
    line = ["source_line_number"] if numbered_lines else []
    return classify(
        calls.select(
            "sample_id",
            *line,
            "source_marker_id",
            "source_chromosome",
            "source_position",
            "raw_genotype",
            "source_build",
            F.concat(F.lit("run-"), F.col("s").cast("string")).alias("ingestion_run_id"),
        )
    )
