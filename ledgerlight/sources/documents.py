"""Landed API documents flattened into entity tables.

Every step is a column expression over nested arrays and structs, so the work runs where
the files are read.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, types as T
from pyspark.sql import functions as F

from ledgerlight import schemas
from ledgerlight.functions.text import filled, join_filled
from ledgerlight.functions.time import from_epoch_ms, from_iso
from ledgerlight.operators.joins import lookup_or_null
from ledgerlight.operators.versions import latest_version
from ledgerlight.sources.tables import conform

UNRATED = "NONE"
#: Ids that stand for no user.
NO_USER = ("", "None", "0")
ERROR = "type string, message string, error string"


def resolve_users(df: DataFrame, users: DataFrame, user: str = "user_id", out: str = "user_email") -> DataFrame:
    """The address of each user id; ``ID_<id>`` where it is unknown, NULL where there is none.

    ``users`` has one row per ``user_id`` with its ``user_email``.  Rows without a user
    are spread by their ids.
    """
    known = users.select(F.col("user_id").alias("__user"), F.col("user_email").alias("__email"))
    real = F.when(~F.col(user).isin(*NO_USER), F.col(user))
    address = F.coalesce("__email", F.concat(F.lit("ID_"), F.col("__user")))
    spread = [f.name for f in df.schema.fields if isinstance(f.dataType, T.AtomicType) and f.name.endswith("id")]
    found = lookup_or_null(df.withColumn("__user", real), known, "__user", spread or [user])
    return found.withColumn(out, address).drop("__user", "__email")


def flatten_messages(raw: DataFrame, users: DataFrame, keep_millis: bool = True) -> DataFrame:
    """One row per message, with its attachments folded into text, ids and counts."""
    attachments = F.coalesce("attachments", F.expr("array()").cast(raw.schema["attachments"].dataType))
    statements = F.filter(F.transform(attachments, lambda a: a["query"]["statement_id"]), lambda s: s != "")
    questions = F.flatten(
        F.filter(F.transform(attachments, lambda a: a["suggested_questions"]["questions"]), F.isnotnull)
    )
    parsed = F.from_json(F.when(F.startswith(F.col("error"), F.lit("{")), F.col("error")), ERROR)
    # text that only looks like JSON has none of the fields and stays text
    error = F.when(F.coalesce(parsed["type"], parsed["message"], parsed["error"]).isNotNull(), parsed)
    plain_error = filled(F.col("error"))
    rows = raw.select(
        "space_id",
        "space_name",
        _message_id(),
        "conversation_id",
        filled(F.col("user_id")).alias("user_id"),
        filled(F.col("status")).alias("status"),
        from_epoch_ms("created_timestamp", keep_millis).alias("created_timestamp"),
        from_epoch_ms("last_updated_timestamp", keep_millis).alias("last_updated_timestamp"),
        F.col("content").alias("user_question"),
        join_filled(F.transform(attachments, lambda a: a["text"]["content"]), " | ").alias("ai_response"),
        join_filled(F.transform(attachments, lambda a: a["query"]["query"]), " | ").alias("sql_query"),
        statements.alias("statement_id"),
        F.size(statements).alias("num_statements"),
        join_filled(questions, ", ").alias("suggested_questions"),
        F.size(attachments).alias("num_attachments"),
        F.coalesce(filled(F.col("feedback.rating")), F.lit(UNRATED)).alias("feedback_rating"),
        F.lit(0).cast("bigint").alias("num_comments"),
        F.when(error.isNotNull(), error["type"]).when(plain_error.isNotNull(), "Unknown").alias("error_type"),
        F.when(error.isNotNull(), F.coalesce(filled(error["message"]), error["error"]))
        .otherwise(plain_error)
        .alias("error_message"),
    )
    return conform(resolve_users(rows, users), schemas.entity("messages"))


def message_statements(raw: DataFrame, users: DataFrame, keep_millis: bool = True) -> DataFrame:
    """One row per query attachment, in its place, whether or not it has a statement id."""
    ran = F.col("attachment.query")
    ran_at_all = F.coalesce(
        ran["query"], ran["statement_id"], ran["description"], ran["query_result_metadata"]["row_count"].cast("string")
    ).isNotNull()
    rows = (
        raw.select(
            "space_id",
            "space_name",
            "conversation_id",
            _message_id(),
            filled(F.col("user_id")).alias("user_id"),
            from_epoch_ms("created_timestamp", keep_millis).alias("created_timestamp"),
            F.posexplode("attachments").alias("attachment_index", "attachment"),
        )
        .filter(ran_at_all)
        .select(
            "*",
            F.col("attachment.attachment_id").alias("attachment_id"),
            filled(ran["statement_id"]).alias("statement_id"),
            F.coalesce(ran["query"], F.lit("")).alias("sql_query"),
            ran["description"].alias("query_description"),
            ran["query_result_metadata"]["row_count"].alias("row_count"),
        )
    )
    return conform(resolve_users(rows, users), schemas.entity("message_statements"))


def message_comments(raw: DataFrame, messages: DataFrame, keep_millis: bool = True) -> DataFrame:
    """One row per comment with text, of messages that were rated.

    ``raw`` has comments of one message per document.  A message may have landed several
    times, each with more comments: all of them count, each comment once and as it was
    written last.  Ids a comment lacks come from its message.
    """
    rated = messages.filter(F.coalesce("feedback_rating", F.lit(UNRATED)) != UNRATED).select("message_id")
    complete = F.col("message_id").isNotNull() & F.col("conversation_id").isNotNull() & F.col("space_id").isNotNull()
    text = F.regexp_replace(F.coalesce("comment.content", F.lit("")), r"^\s+|\s+$", "")
    own = {c: F.coalesce(filled(F.col(f"comment.{c}")), F.col(c)) for c in ("space_id", "conversation_id", "message_id")}
    rows = (
        raw.filter(complete)
        .join(rated, "message_id", "left_semi")
        .withColumn("comment", F.explode("comments"))
        .select(
            F.col("comment.message_comment_id").alias("message_comment_id"),
            "space_name",
            *[column.alias(name) for name, column in own.items()],
            F.col("comment.user_id").alias("user_id"),
            text.alias("comment_text"),
            from_epoch_ms("comment.created_timestamp", keep_millis).alias("created_timestamp"),
        )
        .filter(F.col("comment_text") != "")
    )
    named = latest_version(rows.filter("message_comment_id is not null"), ["message_comment_id"], ["created_timestamp"])
    nameless = rows.filter("message_comment_id is null").distinct()
    return conform(named.unionByName(nameless), schemas.entity("message_comments"))


def with_child_count(parent: DataFrame, child: DataFrame, key: str, out: str = "num_comments") -> DataFrame:
    """The parent rows with the number of child rows of each, zero for none."""
    counts = child.groupBy(key).agg(F.count("*").alias("__count"))
    filled_in = parent.drop(out).join(counts, key, "left")
    return filled_in.withColumn(out, F.coalesce("__count", F.lit(0))).drop("__count")


def acl_counts(df: DataFrame, acl: str = "access_control_list") -> DataFrame:
    """The rows with how many users and groups their access list names."""
    return df.withColumns(
        {
            "num_users_with_access": _named(acl, "user_name"),
            "num_groups_with_access": _named(acl, "group_name"),
        }
    )


def served_models(df: DataFrame, models: str = "config.served_models", out: str = "models") -> DataFrame:
    """The rows with the names of their served models, joined by commas."""
    names = F.transform(F.col(models), lambda m: F.coalesce(filled(m["model_name"]), m["name"]))
    return df.withColumn(out, join_filled(names, ","))


def flatten_apps(raw: DataFrame) -> DataFrame:
    """One row per app, with compute and deployment state as plain text."""
    flat = parse_times(acl_counts(raw), iso=["create_time", "update_time"]).withColumns(
        {
            "app_status": F.col("active_deployment.status.state"),
            "compute_status": F.col("compute_status.state"),
        }
    )
    return conform(flat, schemas.entity("apps"))


def flatten_subscriptions(raw: DataFrame) -> DataFrame:
    """One row per subscription, with its user or its destination under any field name."""
    user, destination = "subscriber.user_subscriber", "subscriber.destination_subscriber"
    flat = parse_times(raw, iso=["create_time"]).withColumns(
        {
            "user_id": F.coalesce(f"{user}.user_id", f"{user}.id"),
            "destination_id": F.coalesce(
                f"{destination}.destination_id", f"{destination}.destination", f"{destination}.id"
            ),
        }
    )
    return conform(flat, schemas.entity("dashboard_subscriptions"))


def parse_times(
    df: DataFrame, epoch_ms: Sequence[str] = (), iso: Sequence[str] = (), keep_millis: bool = True
) -> DataFrame:
    """The rows with epoch-millisecond and ISO columns as timestamps; bad values are NULL."""
    parsed = {c: from_epoch_ms(c, keep_millis) for c in epoch_ms} | {c: from_iso(c) for c in iso}
    return df.withColumns(parsed) if parsed else df


def entity_table(raw: DataFrame, name: str, keep_millis: bool = True) -> DataFrame:
    """The typed table of one kind of entity from its landed documents."""
    return conform(ENTITY_ROWS[name](raw, keep_millis), schemas.entity(name))


#: How the documents of each kind of entity become its rows.
ENTITY_ROWS: dict[str, Callable[[DataFrame, bool], DataFrame]] = {
    "spaces": lambda raw, _: raw.withColumnRenamed("title", "name"),
    "conversations": lambda raw, millis: parse_times(raw, ["created_timestamp"], keep_millis=millis),
    "dashboards": lambda raw, _: parse_times(raw, iso=["create_time", "update_time"]),
    "dashboard_schedules": lambda raw, _: raw,
    "dashboard_subscriptions": lambda raw, _: flatten_subscriptions(raw),
    "models": lambda raw, _: parse_times(acl_counts(raw), ["created_at", "updated_at"]),
    "serving_endpoints": lambda raw, _: parse_times(
        served_models(acl_counts(raw)), ["creation_timestamp", "last_updated_timestamp"]
    ),
    "apps": lambda raw, _: flatten_apps(raw),
}


def _message_id() -> Column:
    return F.coalesce(filled(F.col("message_id")), F.col("id")).alias("message_id")


def _named(acl: str, field: str) -> Column:
    named = F.filter(F.col(acl), lambda entry: entry[field] != "")
    return F.coalesce(F.size(named), F.lit(0))
