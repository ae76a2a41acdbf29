"""Task leases as a stateful stream: who may claim, finish or give back a task.

A task is created once, claimed by an owner for a time, and completed or failed by
that owner while the lease lasts. A claim takes pending, failed and expired tasks;
anything else, such as a late owner's completion, is refused and changes nothing.
State is one small row per task, kept in the stream's checkpoint, so that a run
continues where the last one ended. Finished tasks keep theirs: it is what refuses
a second creation.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concord.plans.registry import query
from concord.session import fresh_path, table

OUT = "task long, event_id long, accepted boolean, status string, failures long"
STATE = "status string, owner long, until_us long, failures long"


def _task(lease_us: int):
    def step(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        status, owner, until, failures = state.get if state.exists else (None, -1, 0, 0)
        rows = pd.concat(list(frames)).sort_values(["at_us", "event_id"])
        out = []
        for event_id, action, token, at in zip(rows["event_id"], rows["action"], rows["token"], rows["at_us"], strict=True):
            if action == "create":
                accepted = status is None
            elif action == "claim":
                accepted = status in ("pending", "retry") or (status == "leased" and until <= at)
            else:
                accepted = status == "leased" and owner == token and at < until
            if accepted:
                status = {"create": "pending", "claim": "leased", "complete": "done", "fail": "retry"}[action]
                if action == "claim":
                    owner, until = int(token), int(at) + lease_us
                failures += action == "fail"
            out.append((key[0], event_id, accepted, status, failures))
        state.update((status, owner, until, failures))
        yield pd.DataFrame(out, columns=["task", "event_id", "accepted", "status", "failures"])

    return step


def lease_stream(actions: DataFrame, lease_seconds: int = 300) -> DataFrame:
    """A stream of actions (task, event_id, action, token, at_us) to what became of each of them.

    Actions of a micro-batch are taken in the order of their time and id; batches must come in order.
    """
    return actions.groupBy("task").applyInPandasWithState(_task(lease_seconds * 1_000_000), OUT, STATE, "append", "NoTimeout")


_HOLD = 3 * 86_400


@query(f"""with recursive e as (select user_id, event_id, event_type, epoch_us(ts) as now, coalesce(json_extract_string(props, '$.k')::int % 2, 0) as token, row_number() over (partition by user_id order by ts, event_id) as rn
  from events where event_type <> 'view' and user_id is not null),
 s as (select user_id, event_id, rn, event_type = 'signup' as accepted, case when event_type = 'signup' then 'pending' end as status, -1 as owner, 0::bigint as until_us, 0::bigint as failures from e where rn = 1
  union all
  select user_id, event_id, rn, ok, case when not ok then status when event_type = 'signup' then 'pending' when event_type = 'click' then 'leased' when event_type = 'purchase' then 'done' else 'retry' end,
   case when ok and event_type = 'click' then token else owner end, case when ok and event_type = 'click' then now + {_HOLD * 1_000_000} else until_us end, failures + (ok and event_type = 'error')::bigint
  from (select e.*, s.status, s.owner, s.until_us, s.failures, coalesce(case e.event_type when 'signup' then s.status is null when 'click' then s.status in ('pending', 'retry') or (s.status = 'leased' and s.until_us <= e.now)
   else s.status = 'leased' and s.owner = e.token and e.now < s.until_us end, false) as ok from s join e on e.user_id = s.user_id and e.rn = s.rn + 1))
 select user_id::bigint as task, event_id::bigint as event_id, accepted, status, failures from s""")
def lease_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Task events land in two parts, the earlier days first; two runs of the stream share one state."""
    action = F.create_map(*(F.lit(x) for kv in (("signup", "create"), ("click", "claim"), ("purchase", "complete"), ("error", "fail")) for x in kv))
    token = F.coalesce(F.get_json_object("props", "$.k").try_cast("int") % 2, F.lit(0)).cast("long")
    actions = table(spark, sf_dir, "events").where("event_type <> 'view' and user_id is not null").select(F.col("user_id").cast("long").alias("task"), F.col("event_id").cast("long").alias("event_id"), action[F.col("event_type")].alias("action"), token.alias("token"), F.unix_micros(F.col("ts").cast("timestamp")).alias("at_us"))
    landed, target, checkpoint = (fresh_path(spark, x) for x in ("landed", "leases", "progress"))
    split = F.unix_micros(F.to_timestamp(F.lit("2024-01-12")))
    for part in (F.col("at_us") < split, F.col("at_us") >= split):
        actions.where(part).write.mode("append").parquet(landed)
        stream = spark.readStream.schema(actions.schema).parquet(landed)
        lease_stream(stream, _HOLD).writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(OUT).parquet(target)
