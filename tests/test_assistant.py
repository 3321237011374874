import pytest
from pyspark.sql import functions as F

from ledgerlight import schemas
from ledgerlight.plans import assistant_cost, reports
from ledgerlight.sources import documents

COST = (
    "statement_id string, query_source_id string, query_source_type string, workspace_id string, statement_text string,"
    " query_work_task_time_seconds double, query_attributed_dollars_estimation double, query_attributed_units_estimation double,"
    " start_time timestamp, end_time timestamp, client_application string"
)


def cost_row(statement, text="SELECT 1", task=1.0, dollars=1.0, kind="ASSISTANT SPACE", space="s1", start="2024-01-05 10:00:00"):
    return (statement, space, kind, "1", text, task, dollars, 2.0, start, "2024-01-05 10:00:30", "app")


@pytest.fixture
def cost(frame):
    return frame(
        COST,
        cost_row("linked", "DESCRIBE linked", dollars=0.5),
        cost_row("probe", "  describe x"),
        cost_row("probing profile", "DESCRIBE SELECT approx_top_k(c)"),
        cost_row("profile", "with sampledData as (select 1) select 1"),
        cost_row("idle", task=0.0),
        cost_row("no text", None),
        cost_row("rest"),
        cost_row("job", kind="JOB", space="j"),
    )


@pytest.fixture
def bridge(frame):
    return frame(
        "space_id string, space_name string, conversation_id string, message_id string, statement_id string, user_email string",
        ("s1", "One", "c", "m1", "linked", "u"), ("s1", "One", "c", "m1", "unknown", "u"),
        ("s1", "One", "c", "m1", None, "u"), ("s1", "One", "c", "m2", None, None),
    )


@pytest.fixture
def messages(frame):
    return frame(
        "space_id string, space_name string, message_id string, conversation_id string, user_question string, created_timestamp timestamp,"
        " feedback_rating string, status string, error_type string, user_email string",
        ("s1", "One", "m1", "c", "why", "2024-01-05", "positive", "COMPLETED", None, "u"),
        ("s1", "One", "m2", "c", "how", "2024-01-05", "NEGATIVE", "FAILED", "E", "u"),
        ("s1", "One", "m3", "d", "who", "2024-01-05", "NONE", "COMPLETED", None, None),
    )


def test_categories_and_classes(cost, bridge, rows):
    got = assistant_cost.categorise_cost(cost, bridge)
    assert rows(got, "statement_id", "cost_category", "cost_class") == [
        ("idle", "METADATA_OTHER", "OVERHEAD_OR_UNATTRIBUTED"),
        ("linked", "CONVERSATIONAL", "USAGE"),
        ("no text", "OTHER_UNATTRIBUTED", "OVERHEAD_OR_UNATTRIBUTED"),
        ("probe", "SCHEMA_PROBE", "OVERHEAD_OR_UNATTRIBUTED"),
        ("probing profile", "SCHEMA_PROBE", "AUTHORING"),
        ("profile", "AUTHORING_PROFILING", "AUTHORING"),
        ("rest", "OTHER_UNATTRIBUTED", "OVERHEAD_OR_UNATTRIBUTED"),
    ]


def test_cost_per_message_counts_what_is_missing(cost, bridge, messages, rows):
    got = assistant_cost.cost_per_message(bridge, cost, messages)
    assert rows(got, "message_id", "num_statements", "num_statements_missing_cost", "message_cost", "user_question") == [
        ("m1", 2, 2, 0.5, "why"), ("m2", 0, 1, 0.0, "how"),
    ]


def test_space_totals_and_their_gap(cost, bridge, messages, rows):
    per_message = assistant_cost.cost_per_message(bridge, cost, messages)
    assert rows(assistant_cost.space_cost(cost)) == [("s1", 6.5)]
    assert rows(assistant_cost.space_cost(cost, workspace="2")) == []
    assert rows(assistant_cost.reconcile_space_cost(cost, per_message)) == [("s1", 6.5, 0.5, 6.0, False)]


def test_reports(cost, messages, rows):
    assert rows(reports.error_mix(messages), "status", "message_count", "pct_of_space") == [("COMPLETED", 2, 66.67), ("FAILED", 1, 33.33)]
    assert rows(reports.user_engagement(messages)) == [("u", 1, 2, 1, 1)]
    picked = reports.space_statements(cost, messages, "2024-01-05", "2024-01-06")
    assert picked.count() == 7
    assert reports.space_statements(cost, messages, "2024-01-05", "2024-01-06", space="other").count() == 0
    trend = reports.cost_trend(cost, messages, "2024-02-01").collect()
    # eight statements and three messages in the hour, neither multiplied by the other
    assert [(r.total_queries, r.assistant_messages, r.total_cost) for r in trend] == [(8, 3, 7.5)]
    sources = {r.query_source_type: r.query_count for r in reports.cost_by_source(cost).collect()}
    assert sources == {"ASSISTANT SPACE": 7, "JOB": 1}


@pytest.fixture
def users(frame):
    return frame("user_id string, user_email string", ("7", "seven@a"))


@pytest.fixture
def raw(spark):
    def attachment(i, **parts):
        return {"attachment_id": f"a{i}", **parts}

    full = [
        attachment(0, text={"content": "answer"}),
        attachment(1, query={"query": "SELECT 1", "statement_id": "st1", "description": "d", "query_result_metadata": {"row_count": 3}}),
        attachment(2, text={"content": ""}),
        attachment(3, query={"query": "SELECT 2", "statement_id": None}),
        attachment(4, suggested_questions={"questions": ["why", "", "how"]}),
        attachment(5, query={}),
    ]
    base = {"space_id": "s", "space_name": "S", "conversation_id": "c", "created_timestamp": 1704067200123, "last_updated_timestamp": None}
    return spark.createDataFrame(
        [
            {**base, "message_id": "m1", "id": "x", "user_id": "7", "content": "q", "status": "DONE", "attachments": full, "feedback": {"rating": "POSITIVE"}, "error": None},
            {**base, "message_id": None, "id": "m2", "user_id": "8", "content": None, "status": "", "attachments": None, "feedback": None, "error": "boom"},
            {**base, "message_id": "m3", "id": None, "user_id": "0", "content": "q", "status": "DONE", "attachments": [], "feedback": {"rating": None}, "error": '{"type":"T","error":"e"}'},
        ],
        schemas.document("message"),
    )


def test_messages_flatten(raw, users, rows):
    got = documents.flatten_messages(raw, users)
    assert got.schema.simpleString() == schemas.entity("messages").simpleString()
    columns = ["message_id", "user_email", "status", "ai_response", "sql_query", "statement_id", "num_statements", "suggested_questions", "num_attachments", "feedback_rating", "error_type", "error_message"]
    assert rows(got, *columns) == [
        ("m1", "seven@a", "DONE", "answer", "SELECT 1 | SELECT 2", ["st1"], 1, "why, how", 6, "POSITIVE", None, None),
        ("m2", "ID_8", None, None, None, [], 0, None, 0, "NONE", "Unknown", "boom"),
        ("m3", None, "DONE", None, None, [], 0, None, 0, "NONE", "T", "e"),
    ]
    assert rows(got.filter("message_id = 'm1'"), "created_timestamp") == [("2024-01-01 00:00:00.123",)]
    assert rows(documents.flatten_messages(raw, users, keep_millis=False).limit(1), "created_timestamp") == [("2024-01-01 00:00:00",)]


def test_statement_bridge_keeps_place_and_missing_ids(raw, users, rows):
    got = documents.message_statements(raw, users)
    assert rows(got, "message_id", "attachment_id", "attachment_index", "statement_id", "sql_query", "row_count") == [
        ("m1", "a1", 1, "st1", "SELECT 1", 3), ("m1", "a3", 3, None, "SELECT 2", None),
    ]


def test_comments_of_rated_messages(spark, frame, rows):
    messages = frame("message_id string, feedback_rating string, num_comments int", ("m1", "NEGATIVE", 0), ("m2", "NONE", 0))

    def document(message):
        return {"space_id": "s", "space_name": "S", "conversation_id": "c", "message_id": message, "comments": [
            {"message_comment_id": "1", "content": " \n bad \t", "created_timestamp": 1704067200000},
            {"message_comment_id": "2", "content": "  "}, {"message_comment_id": "3", "content": "own", "space_id": "t"},
        ]}

    raw = spark.createDataFrame([document("m1"), document("m1"), document("m2")], schemas.document("message_comments"))
    got = documents.message_comments(raw, messages)
    assert rows(got, "message_comment_id", "space_id", "message_id", "comment_text") == [("1", "s", "m1", "bad"), ("3", "t", "m1", "own")]
    assert rows(documents.with_child_count(messages, got, "message_id"), "message_id", "num_comments") == [("m1", 2), ("m2", 0)]


def test_documents_read_from_json(spark, tmp_path, users, rows):
    (tmp_path / "m.json").write_text(
        '{"space_id":"s","message_id":"m","content":"q","error":{"type":"T","message":"bad"},'
        '"attachments":[{"attachment_id":"a","query":{"query":"SELECT 1","statement_id":"st"}}]}\n'
        '{"space_id":"s","id":"n","error":"plain"}\n'
    )
    from ledgerlight.sources.tables import read_documents

    raw = read_documents(spark, str(tmp_path), schemas.document("message"))
    got = documents.flatten_messages(raw, users)
    assert rows(got, "message_id", "statement_id", "error_type", "error_message") == [("m", ["st"], "T", "bad"), ("n", [], "Unknown", "plain")]


def test_other_entities(spark, rows):
    acl = [{"user_name": "u", "group_name": None}, {"user_name": None, "group_name": "g"}, {"user_name": "", "group_name": ""}]
    app = {"name": "a", "id": "1", "create_time": "2024-01-01T02:00:00+02:00", "update_time": "never", "compute_status": {"state": "ACTIVE"},
           "active_deployment": {"status": {"state": "SUCCEEDED"}}, "access_control_list": acl}
    apps = documents.entity_table(spark.createDataFrame([app, {"name": "b"}], schemas.document("app")), "apps")
    assert rows(apps, "name", "create_time", "update_time", "app_status", "compute_status", "num_users_with_access", "num_groups_with_access") == [
        ("a", "2024-01-01 00:00:00", None, "SUCCEEDED", "ACTIVE", 1, 1), ("b", None, None, None, None, 0, 0),
    ]
    endpoint = {"name": "e", "creation_timestamp": 1704067200123, "last_updated_timestamp": 0,
                "config": {"served_models": [{"model_name": "m"}, {"model_name": "", "name": "n"}, {}]}}
    endpoints = documents.entity_table(spark.createDataFrame([endpoint, {"name": "f"}], schemas.document("serving_endpoint")), "serving_endpoints")
    assert rows(endpoints, "name", "creation_timestamp", "last_updated_timestamp", "models") == [
        ("e", "2024-01-01 00:00:00.123", None, "m,n"), ("f", None, None, None),
    ]
    subscriptions = documents.flatten_subscriptions(spark.createDataFrame(
        [{"subscription_id": "1", "subscriber": {"user_subscriber": {"id": "u"}}}, {"subscription_id": "2", "subscriber": {"destination_subscriber": {"destination": "d"}}}],
        schemas.document("subscription")))
    assert rows(subscriptions, "subscription_id", "user_id", "destination_id") == [("1", "u", None), ("2", None, "d")]
    spaces = documents.entity_table(spark.createDataFrame([{"space_id": "s", "title": "T"}], schemas.document("space")), "spaces")
    assert rows(spaces, "space_id", "name") == [("s", "T")]
    assert spaces.select(F.col("warehouse_id")).first()[0] is None


def test_rows_without_a_key_are_kept_and_spread(frame, rows):
    from ledgerlight.operators.joins import lookup_or_null

    left = frame("id int, k string", *[(i, None) for i in range(50)], (50, "a"), (51, "b"))
    right = frame("k string, v string", ("a", "x"), (None, "never"))
    got = lookup_or_null(left, right, "k", ["id"])
    assert rows(got.filter("k is not null"), "id", "v") == [(50, "x"), (51, None)]
    assert got.count() == 52 and got.filter("v is not null").count() == 1
