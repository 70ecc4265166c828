"""Incremental arrival of genotype files: each content is ingested once."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from varloom.operators import qc
from varloom.plans.catalog import _exists, file_digests
from varloom.sources import genotype_text as gt

FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def ingest_batch(
    spark: SparkSession, uris: list[str], batch_id: int, target: str, subjects: DataFrame | None = None
) -> None:
    """Ingest the files of one micro-batch whose content was not stored by another batch.

    Every table is written under ``batch=<id>`` with overwrite, so a retried batch
    replaces its own output instead of repeating it.  ``subjects`` (source_uri, sample_id) names the sample of each file.
    """
    sources = f"{target}/sources"
    digests = file_digests(spark, uris).groupBy("sha256", "byte_size").agg(F.min("uri").alias("uri"))
    if _exists(spark, sources):
        stored = (
            spark.read.parquet(sources).where(F.col("batch") != batch_id).select("sha256")
        )
        digests = digests.join(stored, "sha256", "left_anti")
    digests.write.mode("overwrite").parquet(f"{sources}/batch={batch_id}")
    fresh = [r["uri"] for r in spark.read.parquet(f"{sources}/batch={batch_id}").select("uri").collect()]
    if not fresh:
        return
    parsed = gt.scan(spark, fresh, subjects, run_id=f"stream-{batch_id}")

    def put(name: str, df: DataFrame) -> DataFrame:
        path = f"{target}/{name}/batch={batch_id}"
        df.write.mode("overwrite").parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    # the text is parsed for these three only: quality control reads the written tables, many times over
    obs = put("observations", gt.observations(parsed))
    bad = put("malformed", gt.malformed(parsed))
    meta = put("metadata", gt.source_metadata(parsed))
    put("assay_qc", qc.assay_qc(obs, bad))
    put("findings", qc.findings(obs, bad, meta))


def stream(
    spark: SparkSession,
    folder: str,
    target: str,
    checkpoint: str,
    files_per_batch: int = 1000,
    subjects: DataFrame | None = None,
):
    """Start the file stream; ``files_per_batch`` bounds the paths a batch handles."""
    files = (
        spark.readStream.format("binaryFile")
        .schema(FILE_SCHEMA)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(folder)
        .select("path")
    )

    def handle(batch: DataFrame, batch_id: int) -> None:
        uris = [r["path"] for r in batch.collect()]
        if uris:
            ingest_batch(batch.sparkSession, uris, batch_id, target, subjects)

    return (
        files.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
