"""Platform feeds derived by Spark from the given test tables, always from all their rows.

``oracle.py`` states the same derivations in SQL.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlight import schemas
from ledgerlight.plans.query_cost import QueryFeeds
from ledgerlight.session import use_utc

#: Day the event feeds and the line-item feeds are looked at from.
EVENTS_AS_OF = "2024-02-01"
LINES_AS_OF = "2001-12-01"
#: Days that reach back over every line item.
LINES_DAYS = 2600


def text(prefix: str, number: Column | int) -> Column:
    return F.concat(F.lit(prefix), (number if isinstance(number, Column) else F.lit(number)).cast("string"))


class Feeds:
    """The feeds of one test-data folder."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = use_utc(spark)
        self.folder = folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def events(self) -> DataFrame:
        return self.table("events").select(
            "event_id",
            F.col("ts").cast("timestamp").alias("ts"),
            F.col("user_id").alias("uid"),
            "event_type",
            "value",
            F.expr("substring(props, 7, length(props) - 7)").cast("int").alias("k"),
            "props",
        )

    def _kinds(self, *kinds: str) -> DataFrame:
        return self.events.filter(F.col("event_type").isin(*kinds))

    @cached_property
    def query_history(self) -> DataFrame:
        uid, k = F.col("uid"), F.col("k")
        ten = k % 10
        clients = {1: "Console", 2: "Driver", 3: "Notebook UI"}
        client = F.coalesce(*[F.when(k % 4 == n, label) for n, label in clients.items()])
        statement = (
            F.when(k % 6 == 0, F.concat(F.lit("  describe select * from t"), F.col("event_id").cast("string")))
            .when(k % 6 == 1, F.concat(F.lit("SELECT approx_top_k(c"), k.cast("string"), F.lit(", 1024) FROM t")))
            .when(k % 6 == 2, F.lit("with sampleddata as (select 1) select * from sampleddata"))
            .when(k % 6 == 3, F.lit("DESCRIBE SELECT approx_top_k(c) FROM t"))
            .otherwise(F.concat(F.lit("SELECT "), F.col("props")))
        )
        source = F.struct(
            F.struct(F.when(ten == 0, text("job-", uid)).alias("job_id")).alias("job_info"),
            F.when(k == 11, text("ld-", uid)).alias("legacy_dashboard_id"),
            F.when(ten.isin(1, 2), text("d-", k % 20)).alias("dashboard_id"),
            F.when(ten == 3, text("al-", uid)).alias("alert_id"),
            F.when(ten == 4, text("nb-", uid)).alias("notebook_id"),
            F.when(ten == 5, text("sq-", uid)).alias("sql_query_id"),
            F.when(ten.isin(6, 7, 8), text("sp-", uid % 7)).alias("assistant_space_id"),
        )
        return self.events.filter(F.col("event_type") != "signup").select(
            F.lit("acc-0").alias("account_id"),
            (uid % 25).cast("string").alias("workspace_id"),
            text("st-", F.col("event_id")).alias("statement_id"),
            self._email(uid).alias("executed_by"),
            F.when(k % 20 == 0, "FAILED").otherwise("FINISHED").alias("execution_status"),
            F.struct(
                F.lit("WAREHOUSE").alias("type"),
                F.lit(None).cast("string").alias("cluster_id"),
                text("wh-", uid % 5).alias("warehouse_id"),
            ).alias("compute"),
            statement.alias("statement_text"),
            F.when(k != 97, "SELECT").alias("statement_type"),
            client.alias("client_application"),
            ((k % 5) * 200).cast("bigint").alias("waiting_for_compute_duration_ms"),
            ((k % 7) * 100).cast("bigint").alias("waiting_at_capacity_duration_ms"),
            ((k % 11) * 50).cast("bigint").alias("compilation_duration_ms"),
            F.when(k == 98, 0).otherwise(F.floor(F.col("value") * 1000)).cast("bigint").alias("total_task_duration_ms"),
            ((k % 13) * 30).cast("bigint").alias("result_fetch_duration_ms"),
            F.col("ts").alias("start_time"),
            F.timestamp_add("SECOND", F.floor(F.col("value") * 20), "ts").alias("end_time"),
            source.alias("query_source"),
        )

    @cached_property
    def warehouse_events(self) -> DataFrame:
        k, uid = F.col("k"), F.col("uid")
        return self._kinds("signup").select(
            F.lit("acc-0").alias("account_id"),
            (uid % 25).cast("string").alias("workspace_id"),
            F.when(k == 98, "wh-unused").otherwise(text("wh-", uid % 5)).alias("warehouse_id"),
            F.lit("SCALED").alias("event_type"),
            F.when(k != 99, k % 3).cast("int").alias("cluster_count"),
            F.col("ts").alias("event_time"),
        )

    def _billing(self, rows: DataFrame, product: str | Column, **columns: Column) -> DataFrame:
        """Billing rows from flat columns; the ones not given are NULL."""
        def col(name: str) -> Column:
            return columns.get(name, F.lit(None).cast("string")).alias(name)

        flat = rows.select(
            columns["workspace_id"].alias("workspace_id"),
            columns["sku_name"].alias("sku_name"),
            columns["cloud"].alias("cloud"),
            columns["usage_start_time"].alias("usage_start_time"),
            columns["usage_end_time"].alias("usage_end_time"),
            columns["usage_start_time"].cast("date").alias("usage_date"),
            F.lit("UNIT").alias("usage_unit"),
            columns["usage_quantity"].cast(schemas.QUANTITY).alias("usage_quantity"),
            F.struct(
                col("warehouse_id"), col("endpoint_id"), col("endpoint_name"), col("app_id"), col("app_name"),
                F.struct(col("surface"), col("channel"), col("agent_id")).alias("assistant"),
            ).alias("usage_metadata"),
            F.struct(col("run_as")).alias("identity_metadata"),
            F.struct(F.struct(col("offering_type")).alias("assistant")).alias("product_features"),
            columns.get("record_type", F.lit("ORIGINAL")).alias("record_type"),
            (F.lit(product) if isinstance(product, str) else product).alias("billing_origin_product"),
            columns.get("usage_type", F.lit("COMPUTE")).alias("usage_type"),
        )
        return flat

    @cached_property
    def billing_usage(self) -> DataFrame:
        """Warehouse, app and serving usage, derived from events."""
        uid, day = F.col("uid"), F.date_trunc("day", "ts")
        exact = F.col("value").cast("decimal(18,6)") + F.lit("0.000000123").cast("decimal(18,9)")
        hour, one_hour, one_day = F.date_trunc("hour", "ts"), F.expr("interval 1 hour"), F.expr("interval 1 day")
        warehouse = (
            self.events.filter(F.col("event_type") != "signup")
            .groupBy((uid % 5).alias("wh"), (uid % 2).alias("kind"), hour.alias("start"))
            .agg((F.count("*") * F.lit("0.500000123").cast("decimal(10,9)")).alias("quantity"))
        )
        apps = (
            self._kinds("purchase", "error")
            .groupBy((uid % 40).alias("app"), (uid % 25).alias("ws"), day.alias("start"))
            .agg(F.sum(exact).alias("quantity"))
        )
        serving = (
            self._kinds("view", "error")
            .groupBy((uid % 40).alias("ep"), day.alias("start"))
            .agg(F.sum(exact).alias("quantity"))
        )
        common = {"cloud": F.lit("C0"), "usage_start_time": F.col("start"), "usage_quantity": F.col("quantity")}
        return (
            self._billing(
                warehouse, "SQL", **common,
                workspace_id=F.col("wh").cast("string"),
                sku_name=text("WH_", F.col("kind")),
                usage_end_time=F.col("start") + one_hour,
                warehouse_id=text("wh-", F.col("wh")),
            )
            .unionByName(
                self._billing(
                    apps, "APPS", **common,
                    workspace_id=F.col("ws").cast("string"),
                    sku_name=F.when(F.col("app") == 39, "APP_UNPRICED").otherwise("APP_STD"),
                    usage_end_time=F.col("start") + one_day,
                    app_id=text("a-", F.col("app")),
                    app_name=text("n-", F.col("app") % 5),
                )
            )
            .unionByName(
                self._billing(
                    serving, "MODEL_SERVING", **common,
                    workspace_id=(F.col("ep") % 25).cast("string"),
                    sku_name=F.lit("SERVE_STD"),
                    usage_end_time=F.col("start") + one_day,
                    endpoint_id=text("ep-", F.col("ep")),
                    endpoint_name=text("endpoint ", F.col("ep")),
                )
            )
        )

    @cached_property
    def billing_lines(self) -> DataFrame:
        """Index and assistant usage, derived from every line item."""
        lines = (
            self.table("lineitem")
            .join(self.table("part").select(F.col("p_partkey").alias("l_partkey"), "p_brand"), "l_partkey")
            .join(self.table("supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey"), "l_suppkey")
        )
        start = F.col("l_shipdate").cast("timestamp")
        supp, part = F.col("l_suppkey"), F.col("l_partkey")
        index = F.col("l_linenumber") % 2 == 0
        assistant, attributed, agents = ~index, index & (part % 20 != 0), ~index & (supp % 3 == 2)
        token_sku = F.when(F.col("l_returnflag") == "A", "ASSISTANT_FREE_USAGE").otherwise(
            F.concat(F.lit("REALTIME_INFERENCE_"), F.col("p_brand"))
        )
        surface = F.when(supp % 3 == 0, "CODE").when(supp % 3 == 1, "ONE").otherwise("AGENTS")
        reversal = (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F")
        return self._billing(
            lines,
            F.when(index, "VECTOR_INDEX").otherwise("ASSISTANT"),
            workspace_id=F.col("s_nationkey").cast("string"),
            sku_name=F.when(index, F.col("p_brand")).otherwise(token_sku),
            cloud=text("C", supp % 3),
            usage_start_time=start,
            usage_end_time=start + F.expr("interval 1 hour"),
            usage_quantity=F.col("l_quantity").cast("decimal(18,9)") + F.lit("0.000000123").cast("decimal(18,9)"),
            endpoint_id=F.when(attributed, text("ep-", supp)),
            endpoint_name=F.when(attributed, text("index ", supp)),
            surface=F.when(assistant, surface),
            channel=F.when(assistant, F.when(part % 2 == 0, "UI").otherwise("API")),
            agent_id=F.when(agents, text("sp-", supp % 8)),
            offering_type=F.when(assistant, "STANDARD"),
            run_as=self._email(supp),
            record_type=F.when(assistant & reversal, "RETRACTION").otherwise("ORIGINAL"),
            usage_type=F.when(index | (supp % 10 == 0), "COMPUTE").otherwise("TOKEN"),
        )

    @cached_property
    def list_prices(self) -> DataFrame:
        """Two price periods for the SKUs of events, yearly prices for those of line items."""
        brands = self.table("part").select("p_brand").distinct().filter(F.col("p_brand") != "Brand#25")
        yearly = (
            brands.withColumn("cloud_number", F.explode(F.sequence(F.lit(0), F.lit(2))))
            .withColumn("year", F.explode(F.sequence(F.lit(1995), F.lit(2001))))
            .withColumn("prefix", F.explode(F.array(F.lit(""), F.lit("REALTIME_INFERENCE_"))))
            .select(
                F.concat("prefix", "p_brand").alias("sku_name"),
                text("C", F.col("cloud_number")).alias("cloud"),
                F.make_timestamp("year", F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0)).alias("price_start_time"),
                F.when(
                    F.col("year") < 2001,
                    F.make_timestamp(F.col("year") + 1, F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0)),
                ).alias("price_end_time"),
                (
                    F.lit(100) + (F.col("year") - 1995) * 10 + F.col("cloud_number")
                ).alias("thousandths"),
            )
        )
        change = "2024-01-15 12:00:00"
        steps = [("WH_0", 704, 784), ("WH_1", 224, 256), ("APP_STD", 950, 1000), ("SERVE_STD", 70, 80)]
        rows = [(sku, "2023-01-01 00:00:00", change, old) for sku, old, _ in steps]
        rows += [(sku, change, None, new) for sku, _, new in steps]
        listed = F.array(*[
            F.struct(
                F.lit(sku).alias("sku_name"),
                F.lit("C0").alias("cloud"),
                F.lit(start).cast("timestamp").alias("price_start_time"),
                F.lit(end).cast("timestamp").alias("price_end_time"),
                F.lit(price).alias("thousandths"),
            )
            for sku, start, end, price in rows
        ])
        stepped = self.spark.range(1, numPartitions=1).select(F.inline(listed))
        odd = F.lit("0.000000321").cast("decimal(10,9)")
        price = ((F.col("thousandths") * F.col("times")).cast("decimal(12,3)") / 1000).cast("decimal(18,9)") + odd
        return (
            yearly.unionByName(stepped)
            .withColumn("currency", F.explode(F.array(
                F.struct(F.lit("USD").alias("currency_code"), F.lit(1).alias("times")),
                F.struct(F.lit("EUR").alias("currency_code"), F.lit(2).alias("times")),
            )))
            .select("*", "currency.*")
            .select(
                "price_start_time", "price_end_time", "sku_name", "cloud", "currency_code",
                F.lit("UNIT").alias("usage_unit"),
                F.struct(
                    price.cast(schemas.QUANTITY).alias("default"),
                    F.struct(F.lit(None).cast(schemas.QUANTITY).alias("default")).alias("promotional"),
                    F.struct(price.cast(schemas.QUANTITY).alias("default")).alias("effective_list"),
                ).alias("pricing"),
            )
        )

    @cached_property
    def audit_events(self) -> DataFrame:
        """App, dashboard and assistant-space events, with their parameters in a map."""
        uid, k = F.col("uid"), F.col("k")
        app = F.concat(F.when(k >= 95, "x-").otherwise("n-"), (uid % 5).cast("string"))
        app_key = F.when(k % 3 == 0, "name").when(k % 3 == 1, "app_name").otherwise("app")
        app_value = F.when(k % 3 == 2, F.concat(F.lit('{"name":"'), app, F.lit('"}'))).otherwise(app)
        apps = self._audit(self._kinds("purchase", "click"), "apps", F.lit("deployApp"), app_key, app_value)
        board_action = (
            F.when(k % 10 == 9, "listDashboards").when(k % 2 == 0, "getDashboard").otherwise("getPublishedDashboard")
        )
        boards = self._audit(
            self._kinds("view"), "dashboards", board_action, F.lit("dashboard_id"), text("d-", k % 20)
        )
        space_action = (
            F.when(k % 3 == 0, "getSpace").when(k % 3 == 1, "assistantGetSpace").otherwise("assistantCreateSpace")
        )
        spaces = self._audit(self._kinds("click"), "assistant", space_action, F.lit("space_id"), text("sp-", uid % 8))
        return apps.unionByName(boards).unionByName(spaces)

    def _audit(self, rows: DataFrame, service: str, action: Column, key: Column, value: Column) -> DataFrame:
        email = self._email(F.col("uid"))
        return rows.select(
            (F.col("uid") % 25).cast("string").alias("workspace_id"),
            F.col("ts").alias("event_time"),
            F.col("ts").cast("date").alias("event_date"),
            F.struct(email.alias("email"), F.lit(None).cast("string").alias("subject_name")).alias("user_identity"),
            F.lit(service).alias("service_name"),
            action.alias("action_name"),
            F.create_map(key, value).alias("request_params"),
        )

    @cached_property
    def served_entities(self) -> DataFrame:
        """Configuration versions of 60 served entities on 40 endpoints."""
        uid = F.col("uid")
        entity = uid % 60
        endpoint = entity % 40
        kind = (
            F.when(uid % 4 == 0, "FOUNDATION_MODEL").when(uid % 4 == 1, "EXTERNAL_MODEL")
            .when(uid % 4 == 2, "CUSTOM_MODEL").otherwise("FEATURE_SPEC")
        )
        return self.events.select("uid").distinct().select(
            text("se-", entity).alias("served_entity_id"),
            (endpoint % 25).cast("string").alias("workspace_id"),
            text("endpoint ", endpoint).alias("endpoint_name"),
            text("ep-", endpoint).alias("endpoint_id"),
            kind.alias("entity_type"),
            text("model ", entity).alias("entity_name"),
            F.when(uid % 4 >= 2, uid.cast("string")).alias("entity_version"),
            (F.floor(uid / 60) + 1).cast("int").alias("endpoint_config_version"),
            F.timestamp_add("MINUTE", uid, F.lit("2024-01-01").cast("timestamp")).alias("change_time"),
            F.when(entity == 59, F.lit("2023-06-01").cast("timestamp"))
            .when(entity == 39, F.lit("2023-06-01").cast("timestamp"))
            .when(entity == 38, F.lit("2024-01-20").cast("timestamp"))
            .alias("endpoint_delete_time"),
        )

    @cached_property
    def endpoint_requests(self) -> DataFrame:
        entity = F.col("uid") % 60
        return self._kinds("view", "click").select(
            (entity % 40 % 25).cast("string").alias("workspace_id"),
            text("se-", entity).alias("served_entity_id"),
            self._email(F.col("uid")).alias("requester"),
            F.lit(200).alias("status_code"),
            F.col("ts").alias("request_time"),
            (F.col("k") * 10).cast("bigint").alias("input_token_count"),
            F.when(F.col("k") % 20 != 0, F.floor("value")).cast("bigint").alias("output_token_count"),
        )

    @cached_property
    def workspaces(self) -> DataFrame:
        """All nations but the last, whose workspace stays unknown."""
        return self.table("nation").filter(F.col("n_nationkey") < 24).select(
            F.lit("acc-0").alias("account_id"),
            F.col("n_nationkey").cast("string").alias("workspace_id"),
            F.col("n_name").alias("workspace_name"),
        )

    @cached_property
    def spaces(self) -> DataFrame:
        return self.table("supplier").select((F.col("s_suppkey") % 7).alias("n")).distinct().select(
            text("sp-", F.col("n")).alias("space_id"),
            text("Space ", F.col("n")).alias("name"),
            F.lit(None).cast("string").alias("description"),
            text("wh-", F.col("n") % 5).alias("warehouse_id"),
        )

    @cached_property
    def dashboards(self) -> DataFrame:
        return self.table("part").select((F.col("p_size") % 18).alias("n")).distinct().select(
            text("d-", F.col("n")).alias("dashboard_id"), text("Dashboard ", F.col("n")).alias("display_name")
        )

    @cached_property
    def users(self) -> DataFrame:
        """Addresses of the customers outside one segment; the others stay unknown."""
        return self.table("customer").filter(F.col("c_mktsegment") != "BUILDING").select(
            F.col("c_custkey").cast("string").alias("user_id"),
            F.concat(F.lower("c_name"), F.lit("@example.com")).alias("user_email"),
        )

    @cached_property
    def raw_messages(self) -> DataFrame:
        """A document per user turn, answered by the assistant turn that follows it."""
        conv, turn = F.col("conv_id"), F.col("turn")
        following = Window.partitionBy("conv_id").orderBy("turn")
        turns = self.table("conversations").withColumns(
            {"next_role": F.lead("role").over(following), "next_text": F.lead("text").over(following)}
        )
        asked = (F.col("role") == "user") & (F.col("next_role") == "assistant")
        answer = F.when(asked, F.col("next_text"))
        schema = schemas.document("message")
        attachment = schema["attachments"].dataType.elementType.simpleString()

        def attach(name: str, **parts: Column) -> Column:
            fields = [parts.get(f, F.lit(None)).alias(f) for f in ("text", "query", "suggested_questions")]
            return F.struct(F.lit(name).alias("attachment_id"), *fields).cast(attachment)

        def ran(step: int, statement: Column) -> Column:
            return F.struct(
                F.concat(F.lit(f"SELECT {step} FROM t"), turn.cast("string")).alias("query"),
                statement.alias("statement_id"),
                F.lit(f"step {step}").alias("description"),
                F.struct((conv * 10 + step).alias("row_count")).alias("query_result_metadata"),
            )

        first = text("st-", (conv * 31 + turn * 7) % 1000)
        second = F.when(conv % 5 != 0, text("st-", (conv * 17 + turn * 3) % 1000))
        questions = F.struct(
            F.array(text("What about ", conv), F.lit(""), text("Why ", turn)).alias("questions")
        )
        attachments = F.filter(
            F.array(
                F.when(F.col("answer").isNotNull(), attach("text-0", text=F.struct(F.col("answer").alias("content")))),
                attach("query-1", query=ran(1, first)),
                F.when(turn % 3 == 0, attach("query-2", query=ran(2, second))),
                attach("questions-3", suggested_questions=questions),
            ),
            F.isnotnull,
        )
        message_id = F.concat(conv.cast("string"), F.lit("-"), turn.cast("string"))
        created = F.lit(1704067200123) + conv * 3600000 + turn * 60000
        failed = F.col("answer").isNull()
        return (
            turns.filter(F.col("role") != "assistant")  # a system turn is a message without answer
            .withColumn("answer", answer)
            .select(
                text("sp-", conv % 7).alias("space_id"),
                text("Space ", conv % 7).alias("space_name"),
                F.when(turn % 2 == 0, message_id).alias("message_id"),
                message_id.alias("id"),
                text("cv-", conv).alias("conversation_id"),
                conv.cast("string").alias("user_id"),
                F.col("text").alias("content"),
                F.when(failed, "FAILED").otherwise("COMPLETED").alias("status"),
                created.alias("created_timestamp"),
                (created + 5000).alias("last_updated_timestamp"),
                attachments.alias("attachments"),
                F.struct(F.when(conv % 3 == 0, "POSITIVE").when(conv % 3 == 1, "NEGATIVE").alias("rating")).alias("feedback"),
                F.when(failed & (conv % 4 == 0), "{timeout} while running")
                .when(failed & (conv % 2 == 0), "timeout")
                .when(failed, '{"type":"QUERY_ERROR","message":"bad statement"}')
                .alias("error"),
            )
        )

    @cached_property
    def raw_comments(self) -> DataFrame:
        """Three comments per message, one padded, one blank, one with the whole question.

        Each message has landed twice, the first time with two of them.
        """
        base = self.raw_messages.withColumn("message_id", F.col("id"))
        def comment(n: int, content: Column, own_ids: bool) -> Column:
            missing = F.lit(None).cast("string")
            return F.struct(
                F.concat("message_id", F.lit(f"-c{n}")).alias("message_comment_id"),
                (F.col("space_id") if own_ids else missing).alias("space_id"),
                (F.col("conversation_id") if own_ids else missing).alias("conversation_id"),
                (F.col("message_id") if own_ids else missing).alias("message_id"),
                F.col("user_id").alias("user_id"),
                content.alias("content"),
                (F.col("created_timestamp") + n * 1000).alias("created_timestamp"),
            )
        first = F.array(comment(1, F.lit("not yet"), True), comment(2, F.lit("   "), True))
        again = F.array(
            comment(1, F.concat(F.lit("  fine "), F.col("user_id"), F.lit(" \n")), True),
            comment(2, F.lit("   "), True),
            comment(3, F.col("content"), False),
        )
        earlier = F.transform(first, lambda c: c.withField("created_timestamp", c["created_timestamp"] - 500))
        landed = F.explode(F.array(earlier, again)).alias("comments")
        return base.select("space_id", "space_name", "conversation_id", "message_id", landed)

    @cached_property
    def acl_documents(self) -> DataFrame:
        """A model document per part, with an access list as long as the part's size."""
        entries = F.transform(
            F.sequence(F.lit(1), F.col("p_size")),
            lambda i: F.struct(
                F.when(i % 3 != 0, F.concat(F.lit("u"), i.cast("string"))).alias("user_name"),
                F.when(i % 3 == 0, F.when(i % 2 == 0, "").otherwise("g")).alias("group_name"),
            ),
        )
        nothing = F.lit(None).cast("string")
        return self.table("part").select(
            F.concat(F.lit("main."), F.col("p_brand"), F.lit("."), F.col("p_partkey").cast("string")).alias("full_name"),
            F.col("p_name").alias("name"),
            F.lit("main").alias("catalog_name"),
            F.col("p_brand").alias("schema_name"),
            (F.lit(1700000000456) + F.col("p_partkey") * 1000).alias("created_at"),
            F.lit("u1").alias("created_by"),
            F.when(F.col("p_partkey") % 4 != 0, F.lit(1710000000000)).otherwise(F.lit(-5)).cast("bigint").alias("updated_at"),
            nothing.alias("updated_by"),
            nothing.alias("owner"),
            F.col("p_type").alias("comment"),
            entries.alias("access_control_list"),
        )

    @cached_property
    def endpoint_documents(self) -> DataFrame:
        """A serving-endpoint document per supplier."""
        key = F.col("s_suppkey")
        models = F.transform(
            F.slice(F.array(*[F.lit(i) for i in range(4)]), F.lit(1), (key % 5).cast("int")),
            lambda i: F.struct(
                F.when(i % 2 == 0, F.concat(F.lit("m"), i.cast("string"))).alias("model_name"),
                F.when(i != 3, F.concat(F.lit("n"), i.cast("string"))).alias("name"),
            ),
        )
        acl = F.array(F.struct(F.lit("u").alias("user_name"), F.lit(None).cast("string").alias("group_name")))
        return self.table("supplier").select(
            F.col("s_name").alias("name"),
            key.cast("string").alias("id"),
            (F.lit(1700000000000) + key).alias("creation_timestamp"),
            F.lit("u1").alias("creator"),
            F.when(key % 2 == 0, F.lit(1710000000789)).cast("bigint").alias("last_updated_timestamp"),
            F.lit("READY").alias("state"),
            F.struct(models.alias("served_models")).alias("config"),
            acl.alias("access_control_list"),
        )

    @cached_property
    def app_documents(self) -> DataFrame:
        """An app document per customer, some with times that do not parse."""
        key = F.col("c_custkey")
        none = F.lit(None).cast("string")
        day = F.lpad((key % 28 + 1).cast("string"), 2, "0")
        created = F.concat(F.lit("2023-05-"), day, F.lit("T10:11:12Z"))
        status = lambda state: F.struct(state.alias("state"), none.alias("message"))
        return self.table("customer").select(
            F.col("c_name").alias("name"),
            key.cast("string").alias("id"),
            created.alias("create_time"),
            F.lit("u1").alias("creator"),
            F.when(key % 3 == 0, "not a time").otherwise(F.concat(F.lit("2023-06-"), day, F.lit("T01:02:03.5+02:00"))).alias("update_time"),
            none.alias("updater"),
            F.concat(F.lit("https://apps.example.com/"), key.cast("string")).alias("url"),
            F.when(key % 4 != 0, status(F.when(key % 2 == 0, "ACTIVE").otherwise("STOPPED"))).alias("compute_status"),
            F.when(key % 5 != 0, F.struct(F.when(key % 7 != 0, status(F.lit("SUCCEEDED"))).alias("status"))).alias("active_deployment"),
            F.lit(None).cast("array<struct<user_name:string,group_name:string>>").alias("access_control_list"),
        )

    @cached_property
    def subscription_documents(self) -> DataFrame:
        """A subscription document per order, for a user or a destination."""
        key, cust = F.col("o_orderkey"), F.col("o_custkey").cast("string")
        none = F.lit(None).cast("string")
        user = F.when(
            key % 3 != 0,
            F.struct(F.when(key % 3 == 1, cust).alias("user_id"), F.when(key % 3 == 2, cust).alias("id")),
        )
        kind = F.pmod(F.floor(key / 3), F.lit(3))
        destination = F.when(
            key % 3 == 0,
            F.struct(
                F.when(kind == 0, cust).alias("destination_id"),
                F.when(kind == 1, cust).alias("destination"),
                F.when(kind == 2, cust).alias("id"),
            ),
        )
        return self.table("orders").select(
            text("d-", key % 20).alias("dashboard_id"),
            text("sc-", key % 50).alias("schedule_id"),
            text("su-", key).alias("subscription_id"),
            F.when(F.col("o_orderstatus") == "P", "soon")
            .otherwise(F.date_format(F.col("o_orderdate").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'Z'"))
            .alias("create_time"),
            F.struct(user.alias("user_subscriber"), destination.alias("destination_subscriber")).alias("subscriber"),
            none.alias("unused"),
        )

    @cached_property
    def query_feeds(self) -> QueryFeeds:
        return QueryFeeds(self.query_history, self.warehouse_events, self.billing_usage, self.list_prices)

    @staticmethod
    def _email(uid: Column) -> Column:
        return F.concat(F.lit("u"), uid.cast("string"), F.lit("@example.com"))
