"""Classification rules on columns.

Label sets are plain dictionaries and every function takes one, so a platform with
other names for its surfaces passes its own.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Source label -> field of ``query_source`` that marks it, by priority.
SOURCE_FIELDS: dict[str, str] = {
    "JOB": "job_info.job_id",
    "LEGACY DASHBOARD": "legacy_dashboard_id",
    "DASHBOARD": "dashboard_id",
    "ALERT": "alert_id",
    "NOTEBOOK": "notebook_id",
    "SQL QUERY": "sql_query_id",
    "ASSISTANT SPACE": "assistant_space_id",
}

#: Source label -> path prefix of its page.  Pages of other kinds, such as
#: assistant spaces, have paths of their own on each platform: pass them with these.
LINK_PREFIXES: dict[str, str] = {
    "JOB": "/jobs/",
    "SQL QUERY": "/sql/queries/",
    "DASHBOARD": "/sql/dashboardsv3/",
    "LEGACY DASHBOARD": "/sql/dashboards/",
    "ALERT": "/sql/alerts/",
    "NOTEBOOK": "/editor/notebooks/",
}

#: Fixed value: path prefix of a statement's profile page.
PROFILE_PREFIX = "/sql/history?uiQueryProfileVisible=true&queryId="

#: Upper-case fragments that mark a profiling statement.
PROFILING_MARKS = ("APPROX_TOP_K(", "SAMPLEDDATA")


def source_type(fields: Mapping[str, str] = SOURCE_FIELDS, root: str = "query_source") -> Column:
    """Label of the first marked source, else the client application, else UNKNOWN."""
    labels = [F.when(F.col(f"{root}.{path}").isNotNull(), F.lit(label)) for label, path in fields.items()]
    return F.coalesce(*labels, F.col("client_application"), F.lit("UNKNOWN"))


def source_id(fields: Mapping[str, str] = SOURCE_FIELDS, root: str = "query_source") -> Column:
    """Id of the first marked source, else UNKNOWN."""
    return F.coalesce(*[F.col(f"{root}.{path}") for path in fields.values()], F.lit("UNKNOWN"))


def deep_link(kind: Column, entity_id: Column, prefixes: Mapping[str, str] = LINK_PREFIXES) -> Column:
    """Page path of an entity; empty text for a kind without pages."""
    links = [F.when(kind == label, F.concat(F.lit(prefix), entity_id)) for label, prefix in prefixes.items()]
    return F.coalesce(*links, F.lit(""))


def profile_link(statement_id: Column, prefix: str = PROFILE_PREFIX) -> Column:
    return F.concat(F.lit(prefix), statement_id)


def mentions(text: Column, fragments: Sequence[str]) -> Column:
    """True where the upper-cased text holds one of the fragments."""
    found = F.lit(False)
    for fragment in fragments:
        found = found | F.coalesce(F.contains(F.upper(text), F.lit(fragment)), F.lit(False))
    return found


def activity_category(linked: Column, text: Column, task_seconds: Column) -> Column:
    """What a statement of an assistant space was run for, the first rule that fits."""
    probe = F.startswith(F.upper(F.trim(text)), F.lit("DESCRIBE "))
    idle = F.coalesce(task_seconds, F.lit(0.0)) == 0
    return (
        F.when(linked, "CONVERSATIONAL")
        .when(probe, "SCHEMA_PROBE")
        .when(mentions(text, PROFILING_MARKS), "AUTHORING_PROFILING")
        .when(idle, "METADATA_OTHER")
        .otherwise("OTHER_UNATTRIBUTED")
    )


def activity_class(linked: Column, text: Column) -> Column:
    """Three-way class.  It looks at profiling text before probes, unlike the category."""
    return (
        F.when(linked, "USAGE")
        .when(mentions(text, PROFILING_MARKS), "AUTHORING")
        .otherwise("OVERHEAD_OR_UNATTRIBUTED")
    )
