"""Landing zone: snapshot documents in one folder per entity and day.

Read layout: ``<root>/<entity>/<yyyy>/<MM>/<dd>/<entity>[_<group>]_<batch id>.json``.
Documents written here sit in a ``batch=<id>`` folder below the day, keep the
batch id as the stem of Spark's file names, and fan out into one ``group=<id>``
folder per group, whose share may span many files and tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.functions.batch_ids import day_folder
from headway.schemas import LINEAGE_COLUMN, Entity

GROUP = "group"
# Suffix Spark's committer puts between a stem and the extension.
_WRITER_SUFFIX = r"-\d{5}-[0-9a-f-]{36}.*$"


def day_path(root: str, entity: str, batch_id: str) -> str:
    return f"{root.rstrip('/')}/{entity}/{day_folder(batch_id)}"


def _source_file(entity: str, batch_id: str) -> Column:
    """Base name of the landing document; the same on every retry of a write."""
    name = F.regexp_replace(F.col("_metadata.file_name"), _WRITER_SUFFIX, ".json")
    grouped = F.concat(F.lit(f"{entity}_"), F.col(GROUP), F.lit(f"_{batch_id}.json"))
    return F.when(F.col(GROUP).isNull(), name).otherwise(grouped)


def read_batch(spark: SparkSession, root: str, entity: Entity, batch_id: str, lines: bool = False) -> DataFrame:
    """All documents of one batch: ``data`` and ``source_file``.

    The day folder prunes by path and the glob by name. ``lines`` reads
    newline-delimited documents, which split over tasks; otherwise each file is
    one document that may span lines.
    """
    middle = "_*" if entity.per_route else "_"
    documents = (
        spark.read.schema(f"{entity.document_ddl}, {GROUP} string")
        .option("multiLine", not lines)
        .option("pathGlobFilter", f"{entity.name}{middle}{batch_id}*")
        .json(day_path(root, entity.name, batch_id))
    )
    return documents.select("data", _source_file(entity.name, batch_id).alias(LINEAGE_COLUMN))


def _write(documents: DataFrame, folder: str, root: str, entity: str, batch_id: str) -> str:
    """Text documents below the day folder; writing a batch again replaces it."""
    path = f"{day_path(root, entity, batch_id)}/batch={batch_id}"
    (
        documents.select(folder, "value")
        .write.mode("overwrite")
        .option("mapreduce.output.basename", f"{entity}_{batch_id}")
        .partitionBy(folder)
        .text(path)
    )
    return path


def write_documents(documents: DataFrame, root: str, entity: str, batch_id: str) -> str:
    """Raw documents (unique ``page`` and JSON text ``value``), one file each."""
    return _write(documents, "page", root, entity, batch_id)


def write_grouped(documents: DataFrame, root: str, entity: str, batch_id: str) -> str:
    """Fan-out: newline-delimited documents (``group``, ``value``), a folder per group.

    Rebalancing gives small groups one file and splits a hot group over tasks.
    """
    return _write(documents.hint("rebalance", F.col(GROUP)), GROUP, root, entity, batch_id)


def parse_documents(texts: DataFrame, entity: Entity) -> DataFrame:
    """Document texts (``value``, ``source_file``) as ``data`` and ``source_file``.

    Parsed inside a generator, so filters inferred on ``data`` later on read the
    result instead of parsing the text again below it.
    """
    return texts.select(F.inline(F.array(F.from_json("value", entity.document_ddl))), LINEAGE_COLUMN)
