"""Keyed state (W2, W3, A11): write rules whose outcome depends on the outcome of the write before.

Guards by offset need none of this, a fold takes the highest offset (see `operators.fold`). Optimistic
versions do: each accepted write changes what the next one is compared with, so the writes of one id are
taken one after the other. A micro-batch bounds how many there can be.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from docfold.operators.versions import accepts

# Tasks get this module's functions by value, so executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

STATE = StructType([StructField("exists", BooleanType()), StructField("deleted", BooleanType()), StructField("version", LongType())])
OUTPUT = "id string, offset bigint, op string, asked bigint, applied boolean, stored bigint"
RULES = ("optimistic", "guard", "must_exist")
# Assigned versions stay above the special values 0 (no check) and 1 (must exist).
FIRST_VERSION = 2


def _decide(rule: str, op: str, asked, offset: int, exists: bool, version) -> bool:
    if rule == "guard":
        return version is None or offset > version
    if op == "delete":
        return True
    return exists if rule == "must_exist" else accepts(asked, exists, version)


class _Writes(StatefulProcessor):
    def __init__(self, rule: str, ttl_ms: int | None):
        self._rule, self._ttl_ms = rule, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._state = handle.getValueState("document", STATE, self._ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        frames = [f[["offset", "op", "version", "arrival"]] for f in rows]
        writes = pd.concat(frames).sort_values("arrival", kind="stable")
        stored = self._state.get() if self._state.exists() else (False, False, None)
        exists, deleted, version = bool(stored[0]), bool(stored[1]), stored[2]
        out = []
        for w in writes.itertuples(index=False):
            asked = None if pd.isna(w.version) else int(w.version)
            offset = int(w.offset)
            ok = _decide(self._rule, w.op, asked, offset, exists, version)
            if ok:
                exists, deleted = w.op != "delete", w.op == "delete"
                version = offset if self._rule == "guard" else (offset + FIRST_VERSION if exists else None)
            out.append((key[0], offset, w.op, asked, ok, version))
        self._state.update((exists, deleted, version))
        frame = pd.DataFrame(out, columns=["id", "offset", "op", "asked", "applied", "stored"])
        for c in ("asked", "stored"):
            frame[c] = frame[c].astype("Int64")
        yield frame

    def close(self) -> None:
        pass


def decide_writes(ops: DataFrame, rule: str = "optimistic", ttl_ms: int | None = None) -> DataFrame:
    """Every op with `applied` and the version stored after it, in arrival order per id, across micro-batches.

    `ops`: id, offset, op (set or delete), version (asked, may be NULL), arrival (order of the writes of one
    id). Rules: `optimistic` compares the asked version with the stored one, which becomes offset + 2 when a
    write is accepted; `guard` takes a write only if its offset is above the stored one, deletes included, so a
    late older write never revives a document; `must_exist` refuses sets of missing documents. With `ttl_ms` an id
    not written for that long is forgotten, which does for state what purging old tombstones does for a table.
    The stream needs the RocksDB state store.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {', '.join(RULES)}")
    return ops.groupBy("id").transformWithStateInPandas(
        statefulProcessor=_Writes(rule, ttl_ms), outputStructType=OUTPUT, outputMode="Update",
        timeMode="none" if ttl_ms is None else "processingTime")
