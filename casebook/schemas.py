"""Explicit schemas: JSON documents (parsed once with ``from_json``) and typed tables."""

from pyspark.sql.types import (
    ArrayType, BooleanType, MapType, StringType, StructField, StructType, TimestampType,
)


def _s(*names: str) -> list[StructField]:
    return [StructField(n, StringType()) for n in names]


TAG = StructType(_s("name", "tier"))
NAMED = StructType(_s("name"))
EMAIL = StructType(_s("email"))

TICKET_DOC = StructType(
    _s("id", "sourceType", "status")
    + [
        StructField("customer", StructType(_s("name") + [StructField("tags", ArrayType(TAG))])),
        StructField("assignedToUser", NAMED),
        StructField("submitterUser", EMAIL),
    ]
    + _s("createdAt", "updatedAt", "closedAt", "responseTime", "resolutionTime",
         "waitingOnAgentTime", "waitingOnCustomerTime", "priority")
    + [StructField("ticketType", NAMED)]
    + _s("title", "summary", "sentiment", "channelId", "initialMessageId")
    + [
        StructField("initialMessage", StructType(_s("ts"))),
        StructField("ticketTypeFields", MapType(StringType(), StringType())),
        StructField("messages", ArrayType(StructType(_s("content")))),
    ]
)

MESSAGE_DOC = StructType(
    _s("id", "conversationId", "timestamp", "updatedAt")
    + [StructField("isPrivateNote", BooleanType())]
    + _s("botName")
    + [StructField("user", EMAIL), StructField("sentByUser", EMAIL)]
    + _s("text")
)

CUSTOMER_DOC = StructType(
    _s("id", "name")
    + [
        StructField("slackChannel", StructType(_s("name") + [StructField("isPrivate", BooleanType())])),
        StructField("externalCrmMetadata", StructType(_s("id"))),
        StructField("tags", ArrayType(TAG)),
    ]
)

USER_DOC = StructType(_s("id", "name", "email"))

# Bronze document table: one JSON document per id.
DOCUMENT = StructType([StructField("id", StringType(), False), StructField("data", StringType())])

CLASSIFICATION = StructType(
    [StructField("conversation_id", StringType(), False)]
    + _s("category", "sub_category", "reasoning", "resolution")
    + [StructField("created_at", TimestampType()), StructField("updated_time", TimestampType())]
)

CLUSTER = StructType([StructField("example_id", StringType(), False)]
                     + _s("ticket_id", "summary", "cluster_name", "category"))

STAGING = StructType(_s("conversation_id", "ticket_category", "ticket_sub_category", "ticket_resolution"))

# One model reply item (category / sub-category / reasoning / resolution / error).
REPLY_ITEM = StructType(_s("category", "sub_category", "reasoning", "resolution", "error"))

OUTCOME = StructType([StructField("id", StringType()), StructField("ok", BooleanType()),
                      StructField("error", StringType())])
