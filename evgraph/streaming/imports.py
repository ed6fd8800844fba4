"""A stream of records into published tables, each batch once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.contracts import ENVELOPE, envelope_issues
from ..operators.published import Change, Published


def envelope_batch(lines: DataFrame) -> dict[str, Change]:
    """Lines (value) of NDJSON as changes: valid envelopes as they are, a record twice being one, and lines with their issues."""
    rows = lines.filter(F.trim("value") != "").select("value", F.sha2("value", 256).alias("digest"), F.from_json("value", ENVELOPE).alias("_r")).select("value", "digest", "_r.*")
    whole = F.coalesce(F.schema_of_variant(F.try_parse_json("value")).startswith("OBJECT"), F.lit(False))
    none = F.array(F.struct(F.lit("record.object").alias("code"), F.lit("$").alias("path")))
    judged = envelope_issues(rows, "value").withColumn("issues", F.when(whole, F.col("issues")).otherwise(none))
    good = judged.filter(F.size("issues") == 0).drop("issues", "value")
    bad = judged.filter(F.size("issues") > 0).select("digest", F.col("value").alias("line"), F.col("issues.code").alias("codes"))
    return {"envelope": Change(good, "ignore", ("digest",)), "rejected_line": Change(bad, "ignore", ("digest",))}


def import_stream(lines: DataFrame, store: Published, name: str, checkpoint: str) -> StreamingQuery:
    """Imports all lines (value) that a stream has by now. A batch is published with its number, so one that a killed run has
    published, but not noted in its checkpoint, changes nothing when it is repeated."""
    step = lambda frame, number: store.commit(envelope_batch(frame), batch=(name, number)) and None
    return lines.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
