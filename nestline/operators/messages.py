"""From ranked candidates to one message body per user."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from nestline.config import EMAIL_FIELDS, ENVELOPES, MEMBER_ID_MAX_LENGTH, PUSH_FIELDS

_ADDRESSEE = ("user_id", "variation", "experiment_name")


def message_fields(event_type: str) -> tuple[str, ...]:
    return EMAIL_FIELDS if event_type.endswith("email") else PUSH_FIELDS


def assemble(candidates: DataFrame, fields: Sequence[str],
             per_message: int | None) -> DataFrame:
    """One row per user, variation and experiment with its recommendations in rank order.

    ``seq_id`` decides the order, nulls first, then state and listing. With ``per_message=None``
    each user gets one message; with a number the user's rows are sent that many at a time, and
    ``part`` of ``parts`` says which message it is. Nothing is left out either way.
    """
    order = [F.col("seq_id"), F.col("listing_state"), F.col("listing_id")]
    entry = F.struct(order[0].alias("at"), order[1].alias("state"), order[2].alias("listing"),
                     F.struct(*fields).alias("item"))
    sent = candidates.filter(F.col("variation").isNotNull())
    if per_message is None:
        # rows are dealt out as they come, side by side with others of their listing, before lists
        # are made of them: the rows of one user share nothing and hardly compress
        message = F.struct(*_ADDRESSEE, F.lit(0).alias("part"), F.lit(1).alias("parts"))
        return (sent.select(message.alias("_message"), entry.alias("_entry"))
                .repartition("_message").groupBy("_message")
                .agg(F.sort_array(F.collect_list("_entry")).alias("_entries"))
                .select("_message.*", _items()))
    mine = Window.partitionBy(*_ADDRESSEE)
    place = F.row_number().over(mine.orderBy(*order)) - 1
    # rows lie with their user once they are numbered, so lists are made there and rows in the order
    # of users are not dealt out once more; the frame is one message, however long the user's list
    message = mine.orderBy("part").rangeBetween(Window.currentRow, Window.currentRow)
    return (sent.withColumns({
                "_place": place,
                "parts": F.ceil(F.count(F.lit(1)).over(mine) / per_message).cast("int")})
            .withColumn("part", F.floor(F.col("_place") / per_message).cast("int"))
            .withColumn("_entries", F.collect_list(entry).over(message))
            .filter(F.col("_place") % per_message == 0)
            .withColumn("_entries", F.sort_array("_entries"))
            .select(*_ADDRESSEE, "part", "parts", _items()))


def _items() -> Column:
    return F.transform("_entries", lambda e: e["item"]).alias("recommendations")


def control_messages(bucketed: DataFrame, control: str = "C") -> DataFrame:
    """Users of the control cell get a message without recommendations."""
    return (bucketed.filter(F.col("variation") == control).select(*_ADDRESSEE).distinct()
            .select("user_id", F.lit("").alias("recommendations"), "variation",
                    "experiment_name"))


def envelope(messages: DataFrame, event_type: str, client_id: str, client_name: str) -> DataFrame:
    """Add the addressing columns and the JSON ``body``.

    Short ids are members, long ones visitors; the other of the two is an explicit null, while
    missing fields of a recommendation are left out. Unknown event types use the first template.
    """
    version, kind = ENVELOPES.get(event_type, ENVELOPES["recommended_homes"])
    short = F.length("user_id") <= MEMBER_ID_MAX_LENGTH
    meta = F.struct(
        F.lit(version).alias("version"), F.lit(client_id).alias("clientId"),
        F.lit(client_name).alias("clientName"), F.lit(kind).alias("notificationType"),
        F.struct(F.col("experiment_name").alias("key"), "variation").alias("experiment"))
    recipient = F.struct(F.when(short, F.col("user_id")).alias("memberId"),
                         F.when(~short, F.col("user_id")).alias("visitorId"))
    text = messages.schema["recommendations"].dataType.typeName() == "string"
    items = F.lit('""') if text else F.to_json("recommendations")
    nulls = {"ignoreNullFields": "false"}
    body = F.concat(F.lit('{"meta":'), F.to_json(meta, nulls),
                    F.lit(',"payload":{"content":{"recommendations":'), items,
                    F.lit('},"recipients":'), F.to_json(F.array(recipient), nulls), F.lit("}}"))
    addressed = messages.withColumns({
        "version": F.lit(version), "notification_type": F.lit(kind),
        "member_id": recipient["memberId"], "visitor_id": recipient["visitorId"],
        "body": body})
    # the same message has the same id on every attempt, so a receiver can drop repeats
    return addressed.withColumn("message_id", F.sha2("body", 256))
