"""Schemas of the tables. Columns are never null in use: missing values become the defaults of `DEFAULTS`."""

from __future__ import annotations

from pyspark.sql import types as T

#: backlinks.ordinal is the place of a reference in its record, which settles which of two paths of one edge stays
_S, _L, _TS = T.StringType(), T.LongType(), T.TimestampType()


def _struct(**fields) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


RECORDS = _struct(uri=_S, did=_S, collection=_S, rkey=_S, record=_S, created_at=_TS, indexed_at=_TS, seq=_L)
BACKLINKS = _struct(ref=_S, ref_type=_S, collection=_S, path=_S, source_uri=_S, source_did=_S, created_at=_TS, indexed_at=_TS, ordinal=T.IntegerType())
PENDING_DELETES = _struct(uri=_S, table_name=_S, created_at=_TS)
CURSORS = _struct(name=_S, cursor=_L, updated_at=_TS)
COLLECTION_STATS = _struct(collection=_S, record_count=_L)
POSTS = _struct(uri=_S, did=_S, rkey=_S, created_at=_TS, indexed_at=_TS, text=_S, reply_parent=_S)
LABELS = _struct(uri=_S, did=_S, label=_S)
JOBS = _struct(did=_S, state=_S, updated_at=_TS, step=_L)

OP = _struct(action=_S, path=_S, cid=_S, bytes=T.BinaryType())
EVENTS = _struct(kind=_S, seq=_L, repo=_S, ops=T.ArrayType(OP))
REPOS = _struct(did=_S, path=_S, action=_S, bytes=T.BinaryType())
LINK = "struct<ref:string,ref_type:string,path:string>"

TABLES = {"records": RECORDS, "backlinks": BACKLINKS, "pending_deletes": PENDING_DELETES, "cursors": CURSORS, "collection_stats": COLLECTION_STATS, "posts_by_time_data": POSTS, "labels": LABELS, "jobs": JOBS}

#: key, version (the newest row of a key is current), physical order and partition column of each table
KEYS = {
    "records": (["collection", "did", "rkey"], ["indexed_at", "seq"], ["collection", "did", "rkey"], "month_key"),
    "backlinks": (["ref", "collection", "source_uri"], ["indexed_at", "ordinal"], ["ref", "collection", "source_uri"], "month_key"),
    "cursors": (["name"], ["updated_at"], ["name"], None),
    "posts_by_time_data": (["created_at", "uri"], ["indexed_at"], ["created_at", "uri"], "month_key"),
    "pending_deletes": (None, None, ["table_name", "created_at"], None),
    "collection_stats": (None, None, ["collection"], None),
    "labels": (None, None, ["uri"], None),
    "jobs": (["did"], ["step", "updated_at"], ["did"], None),
}
