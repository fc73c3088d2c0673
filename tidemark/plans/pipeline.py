"""The whole way from landed files to SQL views."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tidemark.plans import gold, silver
from tidemark.schemas import ENTITIES
from tidemark.session import tune
from tidemark.sources.csv import scan_csv_quoted
from tidemark.sources.manifest import manifest_ingest_entities
from tidemark.sources.tables import table_bytes

# Review texts hold line breaks; all other files can be split.
MULTI_LINE = {"order_reviews"}


def run(
    spark: SparkSession, manifest: str, landing: str, root: str, entities: dict[str, str], quarantine: bool = False
) -> list[str]:
    """Ingest the files a manifest lists, clean, model, publish.

    ``entities`` gives the entity of each file name; all files of an entity are read together.
    Bronze, Silver and Gold lie below ``root``. With ``quarantine``, rows with unreadable values
    go to ``rejected`` there and lines that do not fit their header to ``rejected/lines``, with the
    reason; without it they stay, cut or filled up and with the defaults of their columns. Shuffles are sized for all that was landed, since a fact joins most of it. Returns
    the names of the views.
    """
    tune(spark)
    paths = manifest_ingest_entities(
        spark, manifest, landing, f"{root}/bronze", entities, MULTI_LINE, f"{root}/rejected/lines" if quarantine else None)
    raw = {
        entity: scan_csv_quoted(spark, files, [f.source for f in ENTITIES[entity]], entity in MULTI_LINE)
        for entity, files in paths.items()
    }
    tune(spark, table_bytes(spark, [path for files in paths.values() for path in files]))
    cleaned = silver.write(raw, f"{root}/silver", f"{root}/rejected" if quarantine else None)
    tables = gold.write_gold(cleaned, f"{root}/gold", stored=True)
    return gold.publish_views(spark, f"{root}/gold", gold.STAR_TABLES, schemas={n: df.schema for n, df in tables.items()})
