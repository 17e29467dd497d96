"""Late and corrected readings as keyed state of a stream.

Every delivery of a reading carries a version. The state keeps, for each meter
and month, the newest version of each of its readings; a micro-batch emits what it
changes: an ``insert`` for a reading seen first, a pre-image and a post-image
where a newer version replaces an older one, nothing for a version that comes
late behind a newer one. No watermark: a correction may be of any age.

The state of one key is a month of one meter, so it is bounded by the slots of a
month, and a batch calls Python once for a meter's month, not for each day; keys are spread over the state store's partitions and checkpointed with
the query.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

KEY_COLUMNS = ["MeterNumber", "UnitOfMeasure", "FlowDirection", "Channel", "StartDateTime"]
_IN_DAY = KEY_COLUMNS[1:]
CHANGES = ("MeterNumber int, UnitOfMeasure string, FlowDirection string, Channel int, StartDateTime timestamp, "
           "AMIValue decimal(18,2), Version long, _change_type string, Delivery int")
_STATE = ("UnitOfMeasure array<string>, FlowDirection array<string>, Channel array<int>, StartDateTime array<long>, "
          "Version array<long>, AMIValue array<string>")


def corrections(deliveries: DataFrame) -> DataFrame:
    """Change rows of a stream of deliveries: ``KEY_COLUMNS``, ``AMIValue``,
    ``Version`` (of one reading no two alike) and ``Delivery`` (which the change
    rows carry on). Key columns must not be null."""
    def newest(key: tuple, batches: Iterator, state: GroupState) -> Iterator:
        from decimal import Decimal

        import pandas as pd
        columns = list(zip(*state.get)) if state.exists else []
        known = {row[:4]: row[4:] for row in columns}
        # of several versions in one micro-batch only the newest counts
        newest: dict[tuple, tuple] = {}
        for rows in batches:
            start = rows["StartDateTime"].astype("datetime64[us]").astype("int64")
            for row in zip(rows["UnitOfMeasure"], rows["FlowDirection"], rows["Channel"].astype(int), start,
                           rows["Version"].astype(int), rows["AMIValue"].astype(str), rows["Delivery"].astype(int)):
                if row[:4] not in newest or newest[row[:4]][0] < row[4]:
                    newest[row[:4]] = row[4:]
        out = []
        for reading, (version, value, delivery) in newest.items():
            old = known.get(reading)
            if old is not None and old[0] >= version:
                continue
            if old is not None:
                out.append((*reading, old[1], old[0], "update_preimage", delivery))
            out.append((*reading, value, version, "insert" if old is None else "update_postimage", delivery))
            known[reading] = (version, value)
        state.update(tuple(map(list, zip(*[(*k, *v) for k, v in known.items()]))))
        got = pd.DataFrame(out, columns=[*_IN_DAY, "AMIValue", "Version", "_change_type", "Delivery"])
        got["StartDateTime"] = pd.to_datetime(got["StartDateTime"].astype("int64"), unit="us")
        got["AMIValue"] = got["AMIValue"].map(Decimal)
        got.insert(0, "MeterNumber", key[0])
        yield got

    rows = deliveries.select(*KEY_COLUMNS, "AMIValue", "Version", "Delivery",
                             F.trunc("StartDateTime", "month").alias("Month"))
    return rows.groupBy("MeterNumber", "Month").applyInPandasWithState(
        newest, CHANGES, _STATE, "append", GroupStateTimeout.NoTimeout)


def current_readings(changes: DataFrame) -> DataFrame:
    """The newest state of each reading, from its change rows."""
    best = F.max(F.struct("Version", "AMIValue")).alias("m")
    return (changes.filter("_change_type <> 'update_preimage'").groupBy(*KEY_COLUMNS).agg(best)
            .select(*KEY_COLUMNS, "m.AMIValue", "m.Version"))
