"""Disruption notices: XML decoding, region filter and snapshot history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from timepoint.functions.columns import computed_once
from timepoint.functions.timeofday import iso_date_prefix
from timepoint.operators.dedup import keep_latest
from timepoint.sources.storage import append_partitioned

_CONSEQUENCE = (
    "struct<Affects: struct<"
    "StopPoints: struct<AffectedStopPoint: array<struct<StopPointRef: string>>>, "
    "Networks: struct<AffectedNetwork: array<struct<AffectedLine: "
    "array<struct<LineRef: string>>>>>, "
    "Operators: struct<AffectedOperator: array<struct<OperatorRef: string>>>>>"
)
ELEMENT = (
    "SituationNumber string, ParticipantRef string, Progress string, "
    "MiscellaneousReason string, EquipmentReason string, Planned string, Summary string, "
    "ValidityPeriod array<struct<StartTime: string, EndTime: string>>, "
    f"Consequences struct<Consequence: array<{_CONSEQUENCE}>>"
)
ROW_TAG = "PtSituationElement"


def read_situation_files(spark: SparkSession, path: str) -> DataFrame:
    """Situation elements of SIRI-SX files, with the file each came from."""
    return (
        spark.read.format("xml")
        .option("rowTag", ROW_TAG)
        .option("ignoreNamespace", True)
        .schema(ELEMENT)
        .load(path)
        .select(F.struct("*").alias("situation"), F.input_file_name().alias("source"))
    )


def _text(path: str) -> Column:
    return F.nullif(F.trim(F.col(f"situation.{path}")), F.lit(""))


def _refs(per_consequence: Column) -> Column:
    """Array of arrays of text -> one array without NULLs and empty strings."""
    present = F.filter(per_consequence, lambda part: part.isNotNull())
    refs = F.coalesce(F.flatten(present), F.array().cast("array<string>"))
    return F.filter(refs, lambda ref: ref.isNotNull() & (ref != ""))


def flatten_situations(elements: DataFrame, extra: list[str]) -> DataFrame:
    """Situation structs -> one row each with stop, line and operator reference arrays."""
    consequences = F.col("situation.Consequences.Consequence")
    stops = F.transform(
        consequences, lambda c: c["Affects"]["StopPoints"]["AffectedStopPoint"]["StopPointRef"]
    )
    lines = F.transform(
        consequences,
        lambda c: F.flatten(
            F.transform(
                F.filter(
                    c["Affects"]["Networks"]["AffectedNetwork"],
                    lambda net: net["AffectedLine"].isNotNull(),
                ),
                lambda net: net["AffectedLine"]["LineRef"],
            )
        ),
    )
    operators = F.transform(
        consequences, lambda c: c["Affects"]["Operators"]["AffectedOperator"]["OperatorRef"]
    )
    return elements.select(
        _text("SituationNumber").alias("situation_id"),
        _text("ParticipantRef").alias("participant"),
        _text("Progress").alias("progress"),
        F.coalesce(_text("MiscellaneousReason"), _text("EquipmentReason")).alias("reason"),
        F.coalesce(_text("Planned") == "true", F.lit(False)).alias("planned"),
        _text("Summary").alias("summary"),
        F.trim(F.get("situation.ValidityPeriod", F.lit(0))["StartTime"]).alias("validity_start"),
        F.trim(F.get("situation.ValidityPeriod", F.lit(0))["EndTime"]).alias("validity_end"),
        _refs(stops).alias("stop_refs"),
        _refs(lines).alias("line_ref_list"),
        _refs(operators).alias("operator_ref_list"),
        *extra,
    )


def decode_situations(documents: DataFrame, column: str = "element") -> DataFrame:
    """Decode a column of situation elements; other columns are carried along.

    Elements are decoded where they are: a filter on what they say stays behind, so it neither
    decodes them again nor moves the work in front of an exchange that deals them out.
    """
    extra = [c for c in documents.columns if c != column]
    parsed = computed_once(
        documents,
        situation=F.from_xml(column, ELEMENT, {"rowTag": ROW_TAG, "ignoreNamespace": "true"}),
    )
    return flatten_situations(parsed, extra)


def filter_situations_region(situations: DataFrame, prefix: str) -> DataFrame:
    """Drop notices that name stops but none in the region.

    Blanket notices (no stops at all) stay, flagged not region-specific. Reference lists
    become the comma-joined text the stored snapshots use; ``n_affected_stops`` counts all
    stops named, not only those in the region.
    """
    own = F.filter("stop_refs", lambda ref: ref.startswith(prefix))
    extra = [c for c in ("fetched_at", "snapshot_id") if c in situations.columns]
    return (
        situations.withColumn("own_refs", own)
        .filter((F.size("stop_refs") == 0) | (F.size("own_refs") > 0))
        .select(
            "situation_id",
            "participant",
            "progress",
            "reason",
            "planned",
            "summary",
            "validity_start",
            "validity_end",
            F.size("stop_refs").alias("n_affected_stops"),
            F.array_join("own_refs", ",").alias("wy_stop_refs"),
            F.array_join("line_ref_list", ",").alias("line_refs"),
            F.array_join("operator_ref_list", ",").alias("operator_refs"),
            (F.size("own_refs") > 0).alias("wy_specific"),
            *extra,
        )
    )


def append_situation_snapshot(snapshot: DataFrame, path: str) -> None:
    """Add one fetch to the snapshot history, partitioned by fetch date."""
    dated = snapshot.withColumn("fetched_date", iso_date_prefix(F.col("fetched_at")))
    append_partitioned(dated, path, "fetched_date")


def latest_situation(snapshots: DataFrame) -> DataFrame:
    """One row per situation: its most recent snapshot."""
    newest = [c for c in ("fetched_at", "snapshot_id") if c in snapshots.columns]
    return keep_latest(snapshots, ["situation_id"], newest)
