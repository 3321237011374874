"""Declared schemas: platform feeds, entity tables, landed documents and facts.

Each schema is a DDL string turned into a ``StructType``; column comments travel in
the field metadata, where ``sources.tables`` picks them up on write.
"""

from __future__ import annotations

from pyspark.sql import types as T


def struct(ddl: str) -> T.StructType:
    """``StructType`` from a DDL string."""
    return T.StructType.fromDDL(ddl)


QUANTITY = "decimal(38,18)"
MEASURE = "decimal(38,6)"

#: Source feeds, with the columns the operators read.
FEEDS: dict[str, str] = {
    "billing_usage": f"""
        workspace_id string, sku_name string, cloud string,
        usage_start_time timestamp, usage_end_time timestamp, usage_date date,
        usage_unit string, usage_quantity {QUANTITY},
        usage_metadata struct<warehouse_id: string, endpoint_id: string, endpoint_name: string,
            app_id: string, app_name: string,
            assistant: struct<surface: string, channel: string, agent_id: string>>,
        identity_metadata struct<run_as: string>,
        product_features struct<assistant: struct<offering_type: string>>,
        record_type string, billing_origin_product string, usage_type string""",
    "list_prices": f"""
        price_start_time timestamp, price_end_time timestamp, sku_name string, cloud string,
        currency_code string, usage_unit string,
        pricing struct<`default`: {QUANTITY}, promotional: struct<`default`: {QUANTITY}>,
            effective_list: struct<`default`: {QUANTITY}>>""",
    "query_history": """
        account_id string, workspace_id string, statement_id string, executed_by string,
        execution_status string,
        compute struct<type: string, cluster_id: string, warehouse_id: string>,
        statement_text string, statement_type string, client_application string,
        waiting_for_compute_duration_ms bigint, waiting_at_capacity_duration_ms bigint,
        compilation_duration_ms bigint, total_task_duration_ms bigint,
        result_fetch_duration_ms bigint, start_time timestamp, end_time timestamp,
        query_source struct<job_info: struct<job_id: string>, legacy_dashboard_id: string,
            dashboard_id: string, alert_id: string, notebook_id: string, sql_query_id: string,
            assistant_space_id: string>""",
    "warehouse_events": """
        account_id string, workspace_id string, warehouse_id string, event_type string,
        cluster_count int, event_time timestamp""",
    "audit_events": """
        workspace_id string, event_time timestamp, event_date date,
        user_identity struct<email: string, subject_name: string>,
        service_name string, action_name string, request_params map<string, string>""",
    "workspaces": """
        account_id string, workspace_id string, workspace_name string, workspace_url string,
        create_time timestamp, status string""",
    "served_entities": """
        served_entity_id string, workspace_id string, endpoint_name string, endpoint_id string,
        entity_type string, entity_name string, entity_version string,
        endpoint_config_version int, change_time timestamp, endpoint_delete_time timestamp""",
    "endpoint_requests": """
        workspace_id string, served_entity_id string, requester string, status_code int,
        request_time timestamp, input_token_count bigint, output_token_count bigint""",
}

#: Entity tables written from landed documents.
ENTITIES: dict[str, str] = {
    "spaces": "space_id string, name string, description string, warehouse_id string",
    "conversations": """
        space_id string, conversation_id string, created_timestamp timestamp, title string,
        user_id bigint""",
    "messages": """
        space_id string, space_name string, message_id string, conversation_id string,
        user_id string, user_email string, status string, created_timestamp timestamp,
        last_updated_timestamp timestamp, user_question string, ai_response string,
        sql_query string, statement_id array<string>, num_statements int,
        suggested_questions string, num_attachments int, feedback_rating string,
        num_comments bigint, error_type string, error_message string""",
    "message_statements": """
        space_id string, space_name string, conversation_id string, message_id string,
        attachment_id string, attachment_index int, statement_id string, sql_query string,
        query_description string, row_count bigint, user_id string, user_email string,
        created_timestamp timestamp""",
    "message_comments": """
        message_comment_id string, space_id string, space_name string, conversation_id string,
        message_id string, user_id string, comment_text string, created_timestamp timestamp""",
    "dashboards": """
        dashboard_id string, display_name string, create_time timestamp,
        lifecycle_state string, update_time timestamp, warehouse_id string""",
    "dashboard_schedules": """
        dashboard_id string, schedule_id string, create_time string, display_name string,
        pause_status string""",
    "dashboard_subscriptions": """
        dashboard_id string, schedule_id string, subscription_id string, create_time timestamp,
        user_id string, destination_id string""",
    "models": """
        full_name string, name string, catalog_name string, schema_name string,
        created_at timestamp, created_by string, updated_at timestamp, updated_by string,
        owner string, comment string, num_users_with_access int, num_groups_with_access int""",
    "serving_endpoints": """
        name string, id string, creation_timestamp timestamp, creator string,
        last_updated_timestamp timestamp, state string, models string,
        num_users_with_access int, num_groups_with_access int""",
    "apps": """
        name string, id string, create_time timestamp, creator string, update_time timestamp,
        updater string, url string, app_status string, compute_status string,
        num_users_with_access int, num_groups_with_access int""",
}

#: Landed documents that ``sources.documents`` flattens.
DOCUMENTS: dict[str, str] = {
    "message": """
        space_id string, space_name string, message_id string, id string,
        conversation_id string, user_id string, content string, status string,
        created_timestamp bigint, last_updated_timestamp bigint,
        attachments array<struct<
            attachment_id: string, text: struct<content: string>,
            query: struct<query: string, statement_id: string, description: string,
                query_result_metadata: struct<row_count: bigint>>,
            suggested_questions: struct<questions: array<string>>>>,
        feedback struct<rating: string>, error string""",
    "message_comments": """
        space_id string, space_name string, conversation_id string, message_id string,
        comments array<struct<message_comment_id: string, space_id: string,
            conversation_id: string, message_id: string, user_id: string, content: string,
            created_timestamp: bigint>>""",
    "subscription": """
        dashboard_id string, schedule_id string, subscription_id string, create_time string,
        subscriber struct<user_subscriber: struct<user_id: string, id: string>,
            destination_subscriber: struct<destination_id: string, destination: string,
                id: string>>""",
    "model": """
        full_name string, name string, catalog_name string, schema_name string,
        created_at bigint, created_by string, updated_at bigint, updated_by string,
        owner string, comment string,
        access_control_list array<struct<user_name: string, group_name: string>>""",
    "serving_endpoint": """
        name string, id string, creation_timestamp bigint, creator string,
        last_updated_timestamp bigint, state string,
        config struct<served_models: array<struct<model_name: string, name: string>>>,
        access_control_list array<struct<user_name: string, group_name: string>>""",
    "app": """
        name string, id string, create_time string, creator string, update_time string,
        updater string, url string, compute_status struct<state: string, message: string>,
        active_deployment struct<status: struct<state: string, message: string>>,
        access_control_list array<struct<user_name: string, group_name: string>>""",
    "space": "space_id string, title string, description string, warehouse_id string",
    "conversation": """
        space_id string, conversation_id string, created_timestamp bigint, title string,
        user_id bigint""",
    "dashboard": """
        dashboard_id string, display_name string, create_time string, lifecycle_state string,
        update_time string, warehouse_id string""",
    "schedule": """
        dashboard_id string, schedule_id string, create_time string, display_name string,
        pause_status string""",
}

COST_PER_QUERY = """
        statement_id string COMMENT 'Statement',
        query_source_id string COMMENT 'Id of what ran it', query_source_type string COMMENT 'Kind of what ran it',
        client_application string COMMENT 'Client, Unknown where not named',
        executed_by string COMMENT 'Who ran it', warehouse_id string COMMENT 'Warehouse it worked on',
        statement_text string COMMENT 'Text of the statement', workspace_id string COMMENT 'Workspace',
        statement_hour_bucket_costs array<struct<hour_bucket: timestamp,
            hour_attributed_cost: double, hour_attributed_units: double>> COMMENT 'Cost by hour of work',
        start_time timestamp COMMENT 'Start', end_time timestamp COMMENT 'End',
        query_work_start_time timestamp COMMENT 'Start of work, after waiting',
        query_work_end_time timestamp COMMENT 'End of work, after the fetch',
        duration_seconds double COMMENT 'End less start',
        query_work_duration_seconds double COMMENT 'Length of the work',
        query_work_task_time_seconds double COMMENT 'Task, fetch and compile time',
        query_attributed_dollars_estimation double COMMENT 'Share of the used cost of its hours',
        query_attributed_units_estimation double COMMENT 'Share of the used units of its hours',
        url_helper string COMMENT 'Link to what ran it', query_profile_url string COMMENT 'Link to its profile',
        most_recent_billing_hour timestamp COMMENT 'Last billed hour of the window',
        billing_record_check string COMMENT 'Whether all its hours are billed',
        query_start_hour timestamp COMMENT 'Hour of the start'"""

#: Facts, with the comments written to their columns.
FACTS: dict[str, str] = {
    "index_cost": f"""
        endpoint_id string COMMENT 'Index endpoint; NULL for unattributed usage',
        endpoint_name string COMMENT 'Endpoint name, labelled where usage has none',
        usage_date date COMMENT 'Day of the usage',
        workspace_id string COMMENT 'Workspace of the usage',
        workspace_name string COMMENT 'Name from the workspace dimension',
        sku_name string COMMENT 'Billed SKU',
        units {MEASURE} COMMENT 'Usage units, reconciling to billing',
        dollars {MEASURE} COMMENT 'List-price cost of the units'""",
    "app_usage": f"""
        app_id string COMMENT 'App id; the name where the app was never billed',
        app_name string COMMENT 'App name, never NULL',
        usage_date date COMMENT 'Day of the usage or event',
        workspace_id string COMMENT 'Workspace',
        workspace_name string COMMENT 'Name from the workspace dimension',
        units {MEASURE} COMMENT 'Usage units; zero without billing',
        dollars {MEASURE} COMMENT 'List-price cost; zero without billing',
        lifecycle_events bigint COMMENT 'Audit events; zero without any',
        distinct_users bigint COMMENT 'Distinct users in the audit events'""",
    "serving_usage": f"""
        endpoint_id string COMMENT 'Serving endpoint',
        endpoint_name string COMMENT 'Name from the dimension, else from billing',
        served_entity_id string COMMENT 'Representative served entity',
        entity_type string COMMENT 'Type of the representative',
        entity_name string COMMENT 'Name of the representative, else from billing',
        entity_version string COMMENT 'Version of the representative',
        entity_count int COMMENT 'Served entities on the endpoint',
        usage_date date COMMENT 'Day of the usage or cost',
        workspace_id string COMMENT 'Workspace',
        workspace_name string COMMENT 'Name from the workspace dimension',
        request_count bigint COMMENT 'Requests; zero where not tracked',
        input_tokens bigint COMMENT 'Input tokens; zero where not tracked',
        output_tokens bigint COMMENT 'Output tokens; zero where not tracked',
        units {MEASURE} COMMENT 'Usage units, reconciling to billing',
        dollars {MEASURE} COMMENT 'List-price cost of the units'""",
    "token_usage": f"""
        workspace_id string COMMENT 'Workspace of the usage',
        user_email string COMMENT 'Who the usage ran as',
        surface string COMMENT 'Surface the assistant was used on',
        channel string COMMENT 'UI or API',
        agent_id string COMMENT 'Agent or space, NULL outside of one',
        space_name string COMMENT 'Name of the space',
        offering string COMMENT 'Offering type',
        tier string COMMENT 'FREE or PAID, by SKU',
        sku_name string COMMENT 'Billed SKU',
        cloud_region string COMMENT 'Region in the SKU name, NULL for free usage',
        usage_date date COMMENT 'Day of the usage',
        token_units {MEASURE} COMMENT 'Token units, reconciling to billing',
        token_cost {MEASURE} COMMENT 'List-price cost of the units',
        usage_records bigint COMMENT 'Billing records behind the row'""",
    "reach": """
        space_id string COMMENT 'Space', space_name string COMMENT 'Name of the space',
        workspace_id string COMMENT 'Workspace of the activity',
        workspace_name string COMMENT 'Name from the workspace dimension',
        activity_date date COMMENT 'Day of the activity',
        space_views bigint COMMENT 'Views of the space',
        distinct_viewers bigint COMMENT 'Users who viewed it that day; does not add up over days',
        spaces_created bigint COMMENT 'Creations of the space'""",
    "dashboard_views": """
        dashboard_id string COMMENT 'Dashboard', dashboard_name string COMMENT 'Its name',
        workspace_id string COMMENT 'Workspace of the views',
        workspace_name string COMMENT 'Name from the workspace dimension',
        viewed_date date COMMENT 'Day of the views',
        num_views bigint COMMENT 'All views', draft_views bigint COMMENT 'Views as draft',
        published_views bigint COMMENT 'Views as published'""",
    "cost_per_message": """
        message_id string COMMENT 'Message', conversation_id string COMMENT 'Its conversation',
        space_id string COMMENT 'Its space', space_name string COMMENT 'Name of the space',
        user_email string COMMENT 'Who asked', num_statements bigint COMMENT 'Statements that ran',
        num_statements_missing_cost bigint COMMENT 'Statements without a cost record',
        message_cost double COMMENT 'Attributed list-price cost of its statements',
        message_units double COMMENT 'Attributed units of its statements',
        user_question string COMMENT 'What was asked', created_datetime timestamp COMMENT 'When',
        feedback_rating string COMMENT 'How the answer was rated'""",
    "cost_per_query": COST_PER_QUERY,
    "cost_category": COST_PER_QUERY
    + """,
        cost_category string COMMENT 'What the statement was run for',
        cost_class string COMMENT 'Chat or other activity of the space'""",
}


def feed(name: str) -> T.StructType:
    return struct(FEEDS[name])


def entity(name: str) -> T.StructType:
    return struct(ENTITIES[name])


def document(name: str) -> T.StructType:
    return struct(DOCUMENTS[name])


def fact(name: str) -> T.StructType:
    return struct(FACTS[name])
