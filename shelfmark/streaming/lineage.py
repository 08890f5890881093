"""The lineage of listed items as a stream: each sighting of an item at a store is held against its last, and what changed is
an event that names the event of its kind that it supersedes. An item that is not seen again in time is delisted."""

from __future__ import annotations

import datetime as dt
import hashlib
import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

#: A stream that keeps timers needs this store of state.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
EVENT_SCHEMA = "event_id string, at timestamp, store string, item string, event string, was string, now string, supersedes string"
#: What an event of each kind looks at.
_KINDS = {"price": ("price", "list_price"), "discount": ("on_promo", "discount"), "attr": ("name", "section")}
_FIELDS = ("price", "list_price", "on_promo", "discount", "name", "section")


def _spelled(values: tuple) -> str:
    return "/".join("" if v is None else str(v).lower() if isinstance(v, bool) else str(v) for v in values)


def event_id(store: str, item: str, event: str, at_ms: int, now: str) -> str:
    return hashlib.sha1(f"{store}|{item}|{event}|{at_ms}|{now}".encode()).hexdigest()[:16]


def _order(sighting: tuple) -> tuple:
    """By time, then by what is said; what is not said comes last."""
    at, values = sighting
    return at, *((v is None, v) for v in values)


class _Lineage(StatefulProcessor):
    """State of a bucket of items: for each its last sighting, and by kind of event the id of the last one. A timer is set for
    when the first of them should have been seen again; it fires as the watermark passes, whether or not a row comes.

    Each call to the state or a timer goes from Python to the executor and back, and so does each frame: a bucket does that
    once for all its items."""

    def __init__(self, patience_ms: int):
        self.patience = patience_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", "items string")

    def _items(self) -> dict:
        """By store and item: the last sighting (time, fields, whether it is listed) and the ids of events."""
        return {(store, item): (last, ids) for store, item, last, ids in json.loads(self.held.get()[0])} if self.held.exists() else {}

    def _keep(self, items: dict) -> None:
        self.held.update((json.dumps([(*key, *known) for key, known in items.items()]),))
        due = min((last[0] for last, _ in items.values() if last[-1]), default=None)
        if due is not None:
            self.handle.registerTimer(due + self.patience)

    def _event(self, key: tuple, ids: dict, kind: str, at: int, was: str, now: str) -> tuple:
        made = event_id(*key, kind, at, now)
        before, ids[kind] = ids.get(kind), made
        return made, at, *key, kind, was, now, before

    def _until(self, key: tuple, last: list, ids: dict, at: int) -> Iterator[tuple]:
        """A delisting, if the item is not seen within its patience before `at`."""
        due = last[0] + self.patience
        if last[-1] and at > due:
            last[-1] = False
            yield self._event(key, ids, "delist", due, _spelled(last[1:3]), "")

    def _seen(self, key: tuple, last: list | None, ids: dict, at: int, values: list) -> Iterator[tuple]:
        """Events of a sighting; fills in values from the last one."""
        if last is None or not last[-1]:
            yield self._event(key, ids, "new_item", at, "", _spelled(values[:2]))
            return
        if values == last[1:-1]:
            return
        old, new = dict(zip(_FIELDS, last[1:-1])), dict(zip(_FIELDS, values))
        for kind, fields in _KINDS.items():
            # What a sighting does not say of a name or a section is no change.
            looked = [f for f in fields if kind != "attr" or new[f] is not None]
            if any(old[f] != new[f] and not (f == "on_promo" and bool(old[f]) == bool(new[f])) for f in looked):
                yield self._event(key, ids, kind, at, _spelled(tuple(old[f] for f in fields)), _spelled(tuple(new[f] if f in looked else old[f] for f in fields)))
        for k in (4, 5):
            values[k] = old[_FIELDS[k]] if values[k] is None else values[k]

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        items, sightings, out = self._items(), {}, []
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        for frame in rows:
            frame = frame[["store", "item", "ms", *_FIELDS]].astype(object)
            for store, item, at, *values in frame.where(frame.notna(), None).itertuples(index=False, name=None):
                sightings.setdefault((store, item), []).append((int(at), values))
        for item, seen in sightings.items():
            last, ids = items.get(item, (None, {}))
            for at, values in sorted(seen, key=_order) if len(seen) > 1 else seen:
                if last is not None and at < last[0]:
                    continue  # later than what is known of the item
                if last is not None:
                    out += self._until(item, last, ids, at)
                out += self._seen(item, last, ids, at, values)
                last = [at, *values, True]
            items[item] = last, ids
        self._keep(items)
        yield from _frames(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        items, now = self._items(), timerValues.getCurrentWatermarkInMs()
        # No row as old as the watermark comes any more.
        out = [event for item, (last, ids) in items.items() for event in self._until(item, last, ids, now + 1)]
        self._keep(items)
        yield from _frames(out)

    def close(self) -> None:
        pass


def _frames(events: list[tuple]) -> Iterator[pd.DataFrame]:
    if events:
        frame = pd.DataFrame(events, columns=[c.split(" ")[0] for c in EVENT_SCHEMA.split(", ")])
        yield frame.assign(at=pd.to_datetime(frame["at"], unit="ms"))


def lineage_events(sightings: DataFrame, patience: dt.timedelta, late: str = "0 seconds", buckets: int = 1024) -> DataFrame:
    """Events new_item, price, discount, attr and delist of a stream of sightings: store, item, at (timestamp), price,
    list_price, discount (text), on_promo, name, section.

    State lies by buckets of stores and items, so that a large store is many keys and a call does many items. A task holds one
    bucket at a time, its state and its rows of the batch: about a thousand items in each is a good number. With a checkpoint
    `buckets` stays what it was at first. Rows of one batch are taken in the order of time, and an item that comes back after
    its patience is delisted first and then new, whether or not its timer had fired by then: events do not depend on how
    batches are cut. A row without a store or item only moves the watermark; one that is older than the item's last is passed
    over.
    """
    sightings.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    text = [F.col(c).cast("string").alias(c) for c in ("store", "item", "price", "list_price", "discount", "name", "section")]
    rows = sightings.select("at", *text, F.col("on_promo").cast("boolean").alias("on_promo")).withWatermark("at", late)
    # One expression with the time in it: parts that do not look at the time would be filtered before the watermark sees them.
    told = F.when(F.col("at").isNotNull(), F.col("store").isNotNull() & F.col("item").isNotNull()).otherwise(False)
    rows = rows.withColumn("ms", F.unix_millis("at")).filter(told).withColumn("bucket", F.pmod(F.xxhash64("store", "item"), F.lit(buckets)))
    return rows.groupBy("bucket").transformWithStateInPandas(_Lineage(int(patience.total_seconds() * 1000)), EVENT_SCHEMA, "append", "EventTime")


def write_lineage(events: DataFrame, path: str, checkpoint: str, partitions: int | None = None) -> StreamingQuery:
    """Appends what is there to a folder; with the same checkpoint nothing is written twice. `partitions` of the state, the
    session's if not given, are fixed by the checkpoint's first batch."""
    conf = events.sparkSession.conf
    before = conf.get("spark.sql.shuffle.partitions")
    conf.set("spark.sql.shuffle.partitions", str(partitions or before))
    try:  # the stream runs in a copy of the session that is made as it starts
        return events.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        conf.set("spark.sql.shuffle.partitions", before)
