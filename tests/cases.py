"""Small text-typed inputs, generated from the rules under test."""

from pyspark.sql import types as T

TEXT = T.StringType()


def _schema(*fields):
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


CUS_SCHEMA = _schema(
    ("conversation_id", TEXT), ("conversation_start_utc_ts", TEXT), ("conversation_end_utc_ts", TEXT),
    ("conversation_end_utc_date", TEXT), ("visit_guids", T.ArrayType(TEXT, True)))
MSG_SCHEMA = _schema(
    ("conversation_id", TEXT), ("account_id", T.IntegerType()), ("visitor_app_id", TEXT),
    ("conversation_source", TEXT), ("visitor_device_type", TEXT))
LINKED_SCHEMA = _schema(
    ("parent_contact_id", TEXT), ("conversation_start_utc_ts", TEXT), ("conversation_end_utc_ts", TEXT),
    ("conversation_end_utc_date", TEXT), ("visit_guids", T.ArrayType(TEXT, True)), ("app_id", TEXT),
    ("visitor_device_type", TEXT), ("conversation_source", TEXT))

DAY = "2021-11-07"
BEGAN = f"{DAY} 21:30:15.750"
ENDED = f"{DAY} 22:45:00.250"


def customer(i):
    """Conversation i: no ids, an empty list, ids with odd white space, or ids that repeat."""
    ids = [None, [], [f"g{i}\t", f"g {i}"], [f"g{i}", f"g{i}", None]][i % 4]
    return (f"talk:{i:03d}", BEGAN, ENDED, DAY, ids)


def message(i, line=0):
    """Line ``line`` of conversation i; every fifth conversation has no account."""
    return (f"talk:{i:03d}", None if i % 5 == 4 else 40 + i, f"shop-{line}", ("web", "voice")[i % 2], (None, "Tablet", "Phone")[i % 3])


#: Conversations 0 to 8 on the customer side, 3 to 11 on the other; 3 to 8 meet, 6 in two lines.
CUS_ROWS = [customer(i) for i in range(9)]
MSG_ROWS = [message(i) for i in range(11, 2, -1)] + [message(6, 1)]


def linked(cus_rows, msg_rows):
    """The join's definition, row by row."""
    out = []
    for key, began, ended, day, ids in cus_rows:
        for other, account, app, source, device in msg_rows:
            if key is not None and key == other:
                contact = None if account is None else f"{account}-{key}"
                out.append((contact, began, ended, day, ids, app, device, source))
    return out


LINKED_ROWS = linked(CUS_ROWS, MSG_ROWS)
