"""Index of unique values (handles, e-mail addresses) over micro-batches.

Two keyed states: the value an owner holds, and the last owner a value was granted to. That owner may have moved on since, which its own
row tells, so letting go of a value writes nothing to the second.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartstream.operators.claims import grant
from cartstream.operators.upsert import UpsertSpec
from cartstream.streaming.state import KeyedState

ARRIVAL = ("received_at", "webhook_id", "payload_hash")
_ORDER = ("batch", *ARRIVAL)


class ClaimIndex:
    """First claim wins until its owner takes another value or lets go.

    Batches count in their own order, claims of a batch in that of arrival. A claim that arrived before one its owner made in an earlier batch
    comes too late to change the owner's value: it passes and claims nothing.
    """

    def __init__(self, spark: SparkSession, root: str):
        root = root.rstrip("/")
        self.owners = KeyedState(
            spark, f"{root}/owners",
            UpsertSpec(("owner",), {"value": "last", "received_at": "last", "webhook_id": "last"}, order=_ORDER),
        )
        self.values = KeyedState(spark, f"{root}/values", UpsertSpec(("value",), {"owner": "last"}, order=_ORDER))

    def judge(self, claims: DataFrame, batch_id: int) -> DataFrame:
        """`claims` (owner, value, received_at, webhook_id, payload_hash) with `granted` and `late`."""
        asked = claims.select("owner")
        holders = self.values.among(claims.select("value"), before=batch_id)
        if holders is not None:
            asked = asked.unionByName(holders.select("owner"))
        stored = self.owners.among(asked, before=batch_id)
        if stored is None:
            return grant(claims, None, list(ARRIVAL)).withColumn("late", F.lit(False))
        newest = stored.select("owner", F.struct("received_at", "webhook_id").alias("_newest"))
        late = F.coalesce(F.struct("received_at", "webhook_id") < F.col("_newest"), F.lit(False))
        known = claims.join(newest, "owner", "left").select(*claims.columns, late.alias("late"))
        timely = grant(known.filter("not late"), stored.select("owner", "value"), list(ARRIVAL))
        return timely.unionByName(known.filter("late").withColumn("granted", F.lit(True)).select(*timely.columns))

    def store(self, judged: DataFrame, batch_id: int) -> None:
        """Keep what a batch was granted; a second run of the batch replaces the first."""
        kept = judged.filter("granted and not late and owner is not null").withColumn("batch", F.lit(batch_id).cast("bigint"))
        self.owners.apply(kept, batch_id)
        self.values.apply(kept.filter("value is not null"), batch_id)

    def read(self) -> DataFrame | None:
        """(value, owner) of all values held now."""
        owners = self.owners.read()
        return None if owners is None else owners.filter("value is not null").select("value", "owner")
