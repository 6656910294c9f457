"""Registered queries: scans, incremental reads and change events."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from paytide.functions.timing import interval
from paytide.operators import aggregates, compaction
from paytide.plans.oracle import sql
from paytide.plans.registry import query
from paytide.plans.views import Views
from paytide.session import workspace
from paytide.sources import bulk, cdc, increment, reference
from paytide.sources.tables import STORED_SCHEMA
from paytide.streaming import ingest, poll


@query(
    "bulk_load_months",
    sql(
        "tx",
        """SELECT CAST(strftime(created_at, '%Y%m') AS INTEGER) AS yyyymm, count(*) AS n_rows,
          CAST(sum(amount) AS DOUBLE) AS total, max((epoch_us(updated_at) // 1000)) AS max_version,
          CAST(sum(settle_ms) AS DOUBLE) AS settle_ms, 0 AS deleted
        FROM tx GROUP BY 1""",
    ),
)
def bulk_load_months(v: Views):
    """All months in one job, read back from the table."""
    path = workspace(v.spark, "months")
    bulk.bulk_load(v.tx, path, bulk.month_slices(date(2024, 1, 1), date(2024, 3, 1)))
    return compaction.rows(v.spark, path, STORED_SCHEMA).groupBy("yyyymm").agg(
        F.count("*").alias("n_rows"),
        F.sum("amount").alias("total"),
        F.max("_version").alias("max_version"),
        F.sum(F.round(F.col("settlement_seconds") * 1000).cast("decimal(18,0)")).alias("settle_ms"),
        F.sum("_is_deleted").alias("deleted"),
    )


def _mark(v: Views):
    return v.ago("2 days")


@query(
    "incremental_scan",
    sql(
        "tx anchor",
        """SELECT id, updated_at, created_at, status FROM tx, anchor
        WHERE (updated_at, id) >= (as_of - INTERVAL 2 DAY, 1000)
          AND created_at >= as_of - INTERVAL 9 DAY""",
    ),
)
def incremental_scan(v: Views):
    rows = increment.read_increment(v.tx, _mark(v), 1000)
    return rows.select("id", "updated_at", "created_at", "status")


@query(
    "incremental_batch",
    sql(
        "tx anchor",
        """SELECT id, updated_at FROM tx, anchor
        WHERE (updated_at, id) >= (as_of - INTERVAL 20 DAY, 0)
          AND created_at >= as_of - INTERVAL 27 DAY
        ORDER BY updated_at, id LIMIT 500""",
    ),
)
def incremental_batch(v: Views):
    return increment.read_increment(v.tx, v.ago("20 days"), 0, batch=500).select("id", "updated_at")


MOVED = """moved AS (
  SELECT id, status, created_at,
         CASE WHEN status = 'reversed' THEN updated_at + to_days(CAST(id % 20 AS INTEGER))
              ELSE updated_at END AS updated_at
  FROM tx)"""


def _late_reversals(v: Views):
    """Transactions whose reversal came up to 19 days after they were created."""
    late = F.col("updated_at") + F.make_dt_interval(days=(F.col("id") % 20).cast("int"))
    return v.tx.withColumn(
        "updated_at", F.when(F.col("status") == "reversed", late).otherwise(F.col("updated_at"))
    )


@query(
    "full_scan_late_updates",
    sql(
        "tx anchor",
        MOVED
        + """
        SELECT id, updated_at, created_at,
               created_at < as_of - INTERVAL 8 DAY AS below_floor
        FROM moved, anchor WHERE updated_at >= as_of - INTERVAL 1 DAY""",
    ),
)
def full_scan_late_updates(v: Views):
    return increment.full_scan(_late_reversals(v), v.ago("1 day")).select(
        "id", "updated_at", "created_at", (F.col("created_at") < v.ago("8 days")).alias("below_floor")
    )


OVERLAP = """seen AS (
  SELECT t.*, updated_at + to_minutes(k * 10) AS visible_at, as_of - INTERVAL 2 DAY AS wm
  FROM tx t, anchor)"""


def _overlap(v: Views, seconds: int = 21600):
    wm = _mark(v)
    written = v.tx.filter((F.col("updated_at") <= wm) & (v.visible_at(v.tx) <= wm))
    target = bulk.to_raw(written)
    return increment.overlap_window(v.tx, wm, target, seconds)


@query(
    "overlap_reread",
    sql(
        "tx anchor",
        OVERLAP
        + """
        SELECT id, updated_at FROM seen
        WHERE updated_at >= wm - INTERVAL 6 HOUR AND updated_at <= wm AND visible_at > wm""",
    ),
)
def overlap_reread(v: Views):
    return _overlap(v).select("id", "updated_at")


@query(
    "late_rows_captured",
    sql(
        "tx anchor",
        OVERLAP
        + """
        SELECT CASE WHEN updated_at > wm THEN 'resume'
                    WHEN visible_at <= wm THEN 'already written'
                    WHEN updated_at >= wm - INTERVAL 6 HOUR THEN 'overlap'
                    ELSE 'full scan' END AS net,
               count(*) AS n_rows, min(id) AS first_id, max(id) AS last_id
        FROM seen GROUP BY 1""",
    ),
)
def late_rows_captured(v: Views):
    """Which net catches each row around one watermark; together they miss none."""
    wm = _mark(v)
    tx = v.tx
    resumed = tx.filter(F.col("updated_at") > wm).select("id", F.lit("resume").alias("net"))
    overlapped = _overlap(v).select("id", F.lit("overlap").alias("net"))
    visible = v.visible_at(tx)
    below = tx.filter(F.col("updated_at") <= wm)
    landed = below.filter(visible <= wm)
    written = landed.select("id", F.lit("already written").alias("net"))
    # the full scan asks the target about everything below the watermark
    late = increment.lacking(below, bulk.to_raw(landed), F.timestamp_seconds(F.lit(0))).select("id")
    swept = late.join(overlapped.select("id"), "id", "left_anti").select(
        "id", F.lit("full scan").alias("net")
    )
    everything = resumed.unionByName(overlapped).unionByName(written).unionByName(swept)
    return everything.groupBy("net").agg(
        F.count("*").alias("n_rows"), F.min("id").alias("first_id"), F.max("id").alias("last_id")
    )


@query(
    "watermark_advance",
    sql(
        "tx anchor",
        """batch AS (SELECT updated_at, id FROM tx, anchor WHERE updated_at > as_of - INTERVAL 2 DAY)
        SELECT max(updated_at) AS last_updated_at,
               (SELECT max(id) FROM batch WHERE updated_at = (SELECT max(updated_at) FROM batch)) AS last_id,
               count(*) AS rows_synced
        FROM batch""",
    ),
)
def watermark_advance(v: Views):
    return increment.high_mark(v.tx.filter(F.col("updated_at") > _mark(v)))


@query(
    "burst_resume_pages",
    sql(
        "tx",
        """numbered AS (SELECT id, row_number() OVER (ORDER BY id) - 1 AS p, count(*) OVER () AS n FROM tx)
        SELECT CAST(p // ((n + 3) // 4) AS BIGINT) AS page, count(*) AS n_rows, min(id) AS first_id,
               max(id) AS last_id
        FROM numbered GROUP BY 1""",
    ),
)
def burst_resume_pages(v: Views):
    """The whole table as one burst sharing a change time, polled in capped cycles: a quarter each.

    Every cycle resumes right after the pair the previous one ended on; its batch in the mirror is the page.
    """
    at = datetime(2024, 1, 31)
    burst = v.tx.withColumn("updated_at", F.lit(at))
    layout = ingest.Layout(workspace(v.spark, "burst"))
    poll.drain(v.spark, burst, layout, at, batch=-(-v.tx.count() // 4))
    pages = ingest.read_raw(v.spark, layout)
    return pages.groupBy(F.col("batch_id").alias("page")).agg(
        F.count("*").alias("n_rows"), F.min("tx_id").alias("first_id"), F.max("tx_id").alias("last_id")
    )


@query(
    "watermark_ahead",
    sql(
        "tx anchor raw",
        """SELECT make_timestamp(max(_version) * 1000) AS last_updated_at,
          (SELECT max(updated_at) FROM tx) AS source_max_updated_at,
          (SELECT count(*) FROM raw, anchor WHERE _ingested_at >= as_of + INTERVAL 1 DAY) AS rows_written,
          make_timestamp(max(_version) * 1000) >= (SELECT max(updated_at) FROM tx)
            AND (SELECT count(*) FROM raw, anchor WHERE _ingested_at >= as_of + INTERVAL 1 DAY) = 0 AS stuck,
          greatest(epoch_us((SELECT max(updated_at) FROM tx)) - max(_version) * 1000, 0) AS behind_micros
        FROM raw""",
    ),
)
def watermark_ahead(v: Views):
    state = v.raw.agg(F.timestamp_millis(F.max("_version")).alias("last_updated_at"))
    late = v.raw.filter(F.col("_ingested_at") >= v.as_of + interval("1 day"))
    return increment.watermark_health(state, v.tx, late.agg(F.count("*")).scalar())


@query(
    "ref_signature",
    sql(
        "institutions",
        """SELECT count(*) AS n_rows, max(epoch_us(updated_at)) AS max_updated_micros
        FROM institutions""",
    ),
)
def ref_signature(v: Views):
    return reference.ref_signature(v.institutions)


@query(
    "ref_changes",
    sql(
        "accounts",
        """old AS (SELECT * FROM accounts WHERE status <> 'closed')
        SELECT 'closed accounts removed' AS change, (SELECT count(*) FROM old) AS rows_before,
               count(*) AS rows_after, (SELECT count(*) FROM old) <> count(*) AS changed
        FROM accounts""",
    ),
)
def ref_changes(v: Views):
    """A delete moves the signature although the newest change time stays put."""
    stamped = v.accounts.withColumn("updated_at", F.timestamp_seconds(F.lit(0)))
    before = reference.ref_signature(stamped.filter(F.col("status") != "closed"))
    after = reference.ref_signature(stamped)
    was = before.select("n_rows").scalar()
    same = before.select("max_updated_micros").scalar() == F.col("max_updated_micros")
    return after.select(
        F.lit("closed accounts removed").alias("change"),
        was.alias("rows_before"),
        F.col("n_rows").alias("rows_after"),
        ((was != F.col("n_rows")) | ~same).alias("changed"),
    )


@query(
    "dim_institutions",
    sql(
        "institutions",
        """SELECT code, name, short_name, inst_type, CAST(is_active AS INTEGER) AS is_active
        FROM institutions""",
    ),
)
def dim_institutions(v: Views):
    return reference.load_institutions(v.institutions)


# Change events: every transaction becomes one; ``k`` decides which are damaged, and how.
DAMAGE = """CASE k WHEN 10 THEN 'invalid JSON' WHEN 11 THEN 'envelope is not an object'
  WHEN 12 THEN 'payload missing or not an object' WHEN 13 THEN 'op missing'
  WHEN 14 THEN 'row image missing' WHEN 15 THEN 'invalid amount' WHEN 16 THEN 'invalid timestamp'
  WHEN 17 THEN 'invalid updated_at' WHEN 18 THEN 'no version' WHEN 19 THEN 'invalid id'
  WHEN 20 THEN 'missing field' WHEN 24 THEN 'invalid account id' END"""


def change_events(tx):
    """Every transaction as a change event, some damaged in each way the parser must refuse."""
    op = F.when(F.col("k") == 9, "d").when(F.col("k") % 2 == 0, "c").otherwise("u")
    wrapped = cdc.envelope(tx, op, F.unix_millis("created_at"))
    k, value = F.col("k"), F.col("value")

    def swap(pattern: str, new: str):
        return F.regexp_replace(value, pattern, new)

    damaged = (
        F.when(k == 10, F.concat(value, F.lit("}")))
        .when(k == 11, F.concat(F.lit("["), value, F.lit("]")))
        .when(k == 12, swap(r'^\{"payload":', '{"other":'))
        .when(k == 13, swap(r'"op":"[cud]",', ""))
        .when(k == 14, swap(r'"(before|after)":', r'"none":'))
        .when(k == 15, swap(r'"amount":"', r'"amount":"x'))
        .when(k == 16, swap(r'"created_at":"', r'"created_at":"soon '))
        .when(k == 17, swap(r'"updated_at":"', r'"updated_at":"soon '))
        .when(k == 18, F.regexp_replace(swap(r'"updated_at":"[^"]*",', ""), r'"ts_ms":\d+', '"other":1'))
        .when(k == 19, swap(r'"id":(\d+)', r'"id":"n$1"'))
        .when(k == 20, swap(r'"external_id":"[^"]*",', ""))
        .when(k == 21, swap(r'"updated_at":"[^"]*",', ""))
        .when(k == 22, swap(r'"(source|destination)_account_id":\d+,', ""))
        .when(k == 23, swap(r'"currency":"BRL",', ""))
        .when(k == 24, swap(r'"source_account_id":(\d+)', r'"source_account_id":"a$1"'))
        .otherwise(value)
    )
    return wrapped.select(damaged.alias("value"))


@query(
    "cdc_parse",
    sql(
        "tx",
        f"""marked AS (SELECT *, {DAMAGE} AS reason FROM tx)
        SELECT id AS tx_id, external_id, created_at, settled_at, type, status,
          CAST(amount AS DOUBLE) AS amount, currency, source_institution, destination_institution,
          CASE WHEN k = 22 THEN 0 ELSE source_account_id END AS source_account_id,
          CASE WHEN k = 22 THEN 0 ELSE destination_account_id END AS destination_account_id,
          settlement_seconds, metadata,
          CASE WHEN k = 21 THEN (epoch_us(created_at) // 1000) ELSE (epoch_us(updated_at) // 1000) END AS _version,
          CASE WHEN k = 9 THEN 1 ELSE 0 END AS _is_deleted
        FROM marked WHERE reason IS NULL""",
    ),
)
def cdc_parse(v: Views):
    parsed = cdc.parse_cdc(change_events(v.tx))
    return cdc.good_rows(parsed).drop("_ingested_at", "yyyymm")


@query(
    "cdc_dlq_reasons",
    sql(
        "tx",
        f"""marked AS (SELECT {DAMAGE} AS reason FROM tx)
        SELECT reason, count(*) AS n_rows FROM marked WHERE reason IS NOT NULL GROUP BY 1""",
    ),
)
def cdc_dlq_reasons(v: Views):
    letters = cdc.split_dlq(cdc.parse_cdc(change_events(v.tx)))
    return letters.groupBy("reason").agg(F.count("*").alias("n_rows"))


@query(
    "volume_now_json",
    sql(
        "live",
        """a AS (SELECT max(created_at) AS newest FROM raw),
        r AS (SELECT type, count(*) AS n, CAST(sum(amount) AS DOUBLE) AS amount FROM live, a
              WHERE created_at >= newest - INTERVAL 60 MINUTE GROUP BY 1)
        SELECT '{"window":"60m","anchor":"' || strftime((SELECT newest FROM a), '%Y-%m-%dT%H:%M:%S.%f') || '","data":['
          || string_agg('{"type":"' || type || '","tx_count":' || n || ',"total_amount":"'
             || CAST(CAST(amount AS DECIMAL(18,2)) AS VARCHAR) || '"}', ',' ORDER BY n DESC, type)
          || ']}' AS payload
        FROM r""",
    ),
)
def volume_now_json(v: Views):
    rows = aggregates.volume_now(v.raw, 60, v.as_of).withColumn(
        "total_amount", F.col("total_amount").cast("string")
    )
    return aggregates.to_payload(rows, "60m", v.as_of, "type", "tx_count", "total_amount")
