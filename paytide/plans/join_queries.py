"""Registered queries: joins, audits, duplicate detection and ordered neighbours."""

from __future__ import annotations

from pyspark.sql import functions as F

from paytide.functions.position import with_position
from paytide.operators import joins, lifecycle, versions, windows
from paytide.operators import aggregates as agg
from paytide.plans.oracle import sql
from paytide.plans.registry import query
from paytide.plans.views import CONFIG_KEYS, Views

Q2 = """SELECT gap.id, external_reference, CAST(amount_expected AS DOUBLE) AS amount_expected,
  CAST(amount_received AS DOUBLE) AS amount_received, CAST(cents AS DOUBLE) AS difference, external_id, type,
  (SELECT any_value(holder_name) FROM accounts WHERE accounts.id = source_account_id) AS origin,
  (SELECT any_value(holder_name) FROM accounts WHERE accounts.id = destination_account_id) AS destination
FROM (
  SELECT id, external_reference, amount_expected, amount_received, amount_received - amount_expected AS cents,
    {'id': transaction_id, 'at': transaction_created_at} AS payment
  FROM recon WHERE reconciled_at >= (SELECT as_of FROM anchor) - INTERVAL 30 DAY
) gap
JOIN (SELECT {'id': id, 'at': created_at} AS payment, external_id, type, source_account_id, destination_account_id FROM tx) paid
  USING (payment)
WHERE cents NOT BETWEEN -0.01 AND 0.01"""


@query("q2_recon_divergences", sql("recon tx accounts anchor", Q2))
def q2_recon_divergences(v: Views):
    return joins.recon_divergences(v.recon, v.tx, v.accounts, v.as_of)


@query(
    "recon_worst_differences",
    sql(
        "recon tx accounts anchor",
        f"q2 AS ({Q2}) SELECT id, difference FROM q2 ORDER BY abs(difference) DESC, id LIMIT 20",
    ),
)
def recon_worst_differences(v: Views):
    """Order by an expression, with a top-k."""
    rows = joins.recon_divergences(v.recon, v.tx, v.accounts, v.as_of)
    return rows.orderBy(F.abs("difference").desc(), "id").limit(20).select("id", "difference")


@query(
    "legacy_q1_accounts",
    sql(
        "institutions legacy_accounts legacy_users",
        """books AS (
          SELECT institution_id, count_if(status = 'active') AS active, count_if(status = 'blocked') AS blocked,
            sum(CASE status WHEN 'active' THEN balance END) AS held,
            count(CASE status WHEN 'active' THEN balance END) AS holders
          FROM legacy_accounts GROUP BY institution_id
        ), people AS (
          SELECT institution_id, count(*) AS n FROM (
            SELECT DISTINCT institution_id, user_id FROM legacy_accounts
            WHERE user_id IN (SELECT id FROM legacy_users WHERE status = 'active')
          ) GROUP BY institution_id
        )
        SELECT code, name, CAST(coalesce(active, 0) AS BIGINT) AS active_accounts, CAST(coalesce(blocked, 0) AS BIGINT) AS blocked_accounts,
          CAST(held AS DOUBLE) AS total_balance, CAST(held AS DOUBLE) / nullif(holders, 0) AS mean_balance,
          coalesce(n, 0) AS distinct_users
        FROM (SELECT id AS institution_id, code, name FROM institutions WHERE is_active)
        LEFT JOIN books USING (institution_id) LEFT JOIN people USING (institution_id)""",
    ),
)
def legacy_q1_accounts(v: Views):
    return joins.accounts_by_institution(v.institutions, v.legacy_accounts, v.legacy_users)


# The revision that began last, if it has not ended.
CURRENT = """SELECT code, name, config_key, newest.value AS config_value, newest.type AS value_type
FROM (
  SELECT institution_id, config_key, arg_max({{'value': config_value, 'type': value_type, 'until': effective_until}}, effective_from) AS newest
  FROM configs WHERE config_key IN {keys} AND effective_from <= (SELECT as_of FROM anchor) GROUP BY ALL
) last
JOIN (SELECT id AS institution_id, code, name FROM institutions WHERE is_active) active USING (institution_id)
WHERE newest.until IS NULL OR newest.until > (SELECT as_of FROM anchor)"""


@query(
    "legacy_q2_current_config",
    sql("institutions configs anchor", CURRENT.format(keys=str(CONFIG_KEYS))),
)
def legacy_q2_current_config(v: Views):
    return joins.current_config(v.institutions, v.configs, v.as_of, list(CONFIG_KEYS))


@query(
    "config_keys_in",
    sql("institutions configs anchor", CURRENT.format(keys="('pix_fee', 'daily_limit')")),
)
def config_keys_in(v: Views):
    return joins.current_config(v.institutions, v.configs, v.as_of, ["pix_fee", "daily_limit"])


@query(
    "config_history_expand",
    sql(
        "configs",
        """SELECT institution_id, config_key, config_value, value_type, revision, effective_from,
          effective_until FROM configs""",
    ),
)
def config_history_expand(v: Views):
    return v.configs


@query(
    "config_point_in_time",
    sql(
        "tx institutions configs",
        """SELECT t.type, c.config_value, count(*) AS n_rows, CAST(sum(t.amount) AS DOUBLE) AS total
        FROM tx t
        LEFT JOIN (SELECT i.code, c.* FROM configs c JOIN institutions i ON i.id = c.institution_id
                   WHERE config_key = 'pix_fee') c
          ON c.code = t.source_institution AND c.effective_from <= t.created_at
         AND (c.effective_until IS NULL OR c.effective_until > t.created_at)
        GROUP BY 1, 2""",
    ),
)
def config_point_in_time(v: Views):
    rows = joins.config_as_of_row(v.tx, v.institutions, v.configs, "pix_fee")
    return rows.groupBy("type", "config_value").agg(
        F.count("*").alias("n_rows"), F.sum("amount").alias("total")
    )


PAIRS = """SELECT earlier.id AS id_a, later.id AS id_b, CAST(earlier.amount AS DOUBLE) AS amount,
  earlier.created_at AS created_at_a, later.created_at AS created_at_b
FROM (SELECT * FROM {source} WHERE created_at + INTERVAL {days} DAY >= (SELECT as_of FROM anchor)) earlier
JOIN (SELECT id, created_at, {keys} FROM {source}) later USING ({keys})
WHERE later.id > earlier.id AND later.created_at >= earlier.created_at
  AND later.created_at - earlier.created_at <= INTERVAL 5 MINUTE"""
LOOSE = ("source_account_id", "type")
STRICT = ("amount", "source_account_id", "destination_account_id")
# Payments seldom repeat to the cent here, so amounts are also compared rounded to tens.
COARSE = """coarse AS (SELECT * REPLACE (CAST(floor(amount / 10) AS DECIMAL(18,2)) AS amount,
  destination_account_id % 3 AS destination_account_id, source_account_id % 3 AS source_account_id) FROM tx)"""


def _coarse(v: Views):
    return (
        v.tx.withColumn("amount", F.floor(F.col("amount") / 10).cast("decimal(18,2)"))
        .withColumn("destination_account_id", F.col("destination_account_id") % 3)
        .withColumn("source_account_id", F.col("source_account_id") % 3)
    )


@query(
    "q4_duplicate_pairs",
    sql("tx anchor", PAIRS.format(source="tx", keys=", ".join(LOOSE), days=30)),
)
def q4_duplicate_pairs(v: Views):
    return joins.duplicate_pairs(v.tx, v.as_of, days=30, keys=LOOSE)


@query(
    "q4_duplicate_pairs_payment_keys",
    sql(
        "tx anchor",
        f"{COARSE} " + PAIRS.format(source="coarse", keys=", ".join(STRICT), days=7),
    ),
)
def q4_duplicate_pairs_payment_keys(v: Views):
    return joins.duplicate_pairs(_coarse(v), v.as_of)


LAG = """w AS (SELECT *, lag(created_at) OVER o AS previous_at, lag(id) OVER o AS previous_id
  FROM {source}, anchor WHERE created_at >= as_of - INTERVAL {days} DAY
  WINDOW o AS (PARTITION BY {keys} ORDER BY created_at, id))
SELECT id, previous_id, external_id, CAST(amount AS DOUBLE) AS amount, created_at, previous_at,
  (epoch_us(created_at) - epoch_us(previous_at)) / 1e6 AS seconds_between
FROM w WHERE previous_at IS NOT NULL AND created_at - previous_at <= INTERVAL 5 MINUTE"""


@query(
    "q4_duplicates_lag",
    sql("tx anchor", LAG.format(source="tx", days=30, keys="source_account_id, type")),
)
def q4_duplicates_lag(v: Views):
    return windows.duplicates_consecutive(v.tx, v.as_of, days=30, keys=LOOSE)


@query(
    "q4_duplicates_lag_payment_keys",
    sql(
        "tx anchor",
        f"{COARSE}, "
        + LAG.format(
            source="coarse", days=7, keys="amount, source_account_id, destination_account_id"
        ),
    ),
)
def q4_duplicates_lag_payment_keys(v: Views):
    return windows.duplicates_consecutive(_coarse(v), v.as_of)


@query(
    "fraud_duplicates",
    sql(
        "live",
        """a AS (SELECT max(created_at) AS as_of FROM raw),
        w AS (SELECT *, lag(created_at) OVER (PARTITION BY source_account_id, type
               ORDER BY created_at, tx_id) AS previous_at
          FROM live, a WHERE created_at >= as_of - INTERVAL 168 HOUR)
        SELECT external_id, tx_id, CAST(amount AS DOUBLE) AS amount, created_at, status,
          source_account_id, destination_account_id, previous_at,
          date_diff('second', previous_at, created_at) AS seconds_apart
        FROM w WHERE previous_at IS NOT NULL AND date_diff('second', previous_at, created_at) <= 900
        ORDER BY created_at DESC, tx_id DESC LIMIT 100""",
    ),
)
def fraud_duplicates(v: Views):
    return windows.fraud_duplicates(
        v.raw, v.as_of, hours=168, window_seconds=900, limit=100, keys=LOOSE
    )


@query(
    "stage_durations",
    sql(
        "status_log",
        """w AS (SELECT *, lead(changed_at) OVER (PARTITION BY tx_id ORDER BY changed_at, seq) AS left_at
          FROM status_log)
        SELECT tx_id, type, status, changed_at, seq, left_at,
          (epoch_us(left_at) - epoch_us(changed_at)) / 1e6 AS seconds_in_stage FROM w""",
    ),
)
def stage_durations(v: Views):
    return windows.stage_durations(v.status_log)


@query(
    "dict_lookup_default",
    sql(
        "tx dict",
        """SELECT t.source_institution AS code, coalesce(d.name, t.source_institution) AS or_code,
          coalesce(d.short_name, '(unknown ' || t.source_institution || ')') AS or_marker,
          coalesce(d.inst_type, 'none') AS or_constant, count(*) AS n_rows
        FROM tx t LEFT JOIN dict d ON d.code = t.source_institution GROUP BY ALL""",
    ),
)
def dict_lookup_default(v: Views):
    per_code = v.tx.groupBy("source_institution").agg(F.count("*").alias("n_rows"))
    code = F.col("source_institution")
    marker = F.concat(F.lit("(unknown "), code, F.lit(")"))
    named = joins.lookup(per_code, v.dictionary, "source_institution", "name", code)
    named = joins.lookup(named, v.dictionary, "source_institution", "short_name", marker)
    named = joins.lookup(named, v.dictionary, "source_institution", "inst_type", F.lit("none"))
    return named.select(
        code.alias("code"),
        F.col("source_institution_name").alias("or_code"),
        F.col("source_institution_short_name").alias("or_marker"),
        F.col("source_institution_inst_type").alias("or_constant"),
        "n_rows",
    )


@query(
    "dict_coverage",
    sql(
        "tx dict",
        """SELECT count(*) AS n_rows, count(d.code) AS resolved,
          count(DISTINCT t.source_institution) AS codes, count(DISTINCT d.code) AS codes_resolved
        FROM tx t LEFT JOIN dict d ON d.code = t.source_institution""",
    ),
)
def dict_coverage(v: Views):
    return joins.dict_coverage(v.tx, v.dictionary)


@query(
    "dim_join_group",
    sql(
        "tx accounts",
        """SELECT a.institution_code, a.status, t.type, count(*) AS n_rows,
          CAST(sum(t.amount) AS DOUBLE) AS total
        FROM tx t JOIN accounts a ON a.id = t.source_account_id GROUP BY 1, 2, 3""",
    ),
)
def dim_join_group(v: Views):
    """A dimension that grows: rows are reduced per account before they meet it."""
    per_account = v.tx.groupBy(F.col("source_account_id").alias("id"), "type").agg(
        F.count("*").alias("n"), F.sum("amount").alias("s")
    )
    named = per_account.join(v.accounts.select("id", "institution_code", "status"), "id")
    return named.groupBy("institution_code", "status", "type").agg(
        F.sum("n").alias("n_rows"), F.sum("s").alias("total")
    )


@query(
    "cagg_vs_raw_divergence",
    sql(
        "tx hourly anchor",
        """raw_side AS (SELECT date_trunc('month', created_at) AS month, type, status, count(*) AS n,
            sum(amount) AS s FROM tx, anchor
            WHERE created_at >= date_trunc('hour', as_of - INTERVAL 20 DAY) GROUP BY 1, 2, 3),
        agg_side AS (SELECT date_trunc('month', bucket) AS month, type, status, sum(tx_count) AS n,
            sum(total_amount) AS s FROM hourly, anchor
            WHERE bucket >= date_trunc('hour', as_of - INTERVAL 20 DAY) GROUP BY 1, 2, 3)
        SELECT count(*) AS groups,
          count(*) FILTER (WHERE r.n IS DISTINCT FROM g.n OR r.s IS DISTINCT FROM g.s) AS divergent
        FROM raw_side r FULL JOIN agg_side g USING (month, type, status)""",
    ),
)
def cagg_vs_raw_divergence(v: Views):
    from paytide.functions.timing import aligned_cut

    cut = aligned_cut(v.as_of, "20 days", "hour")
    raw = agg.volume_by_type_status(v.tx, cut)
    rolled = agg.rollup(agg.volume_hourly(v.tx), "month", "type", "status", since=cut)
    diff = joins.diff_aggregates(
        raw, rolled, ["month", "type", "status"], ["tx_count", "total_amount"]
    )
    return diff.agg(F.count("*").alias("groups"), F.count_if("differs").alias("divergent"))


TOUCHED = """parts AS (SELECT DISTINCT time_bucket(INTERVAL '{hours} hours', created_at, TIMESTAMP '2024-01-01 05:00:00') AS range_start FROM tx),
  hits AS (SELECT DISTINCT time_bucket(INTERVAL '{hours} hours', created_at, TIMESTAMP '2024-01-01 05:00:00') AS range_start
    FROM tx WHERE source_account_id = 7)
  SELECT range_start, range_start + INTERVAL '{hours} hours' AS range_end FROM parts SEMI JOIN hits USING (range_start)"""


def _partitions_touched(v: Views, hours: int):
    """Partitions of a width that need not divide a day, starting at five in the morning."""
    micros = hours * 3_600_000_000
    first = F.unix_micros(F.lit("2024-01-01 05:00:00").cast("timestamp"))
    start = F.timestamp_micros(first + F.floor((F.unix_micros("created_at") - first) / F.lit(micros)) * F.lit(micros))
    parts = v.tx.select(start.alias("range_start")).distinct()
    parts = parts.withColumn("range_end", F.timestamp_micros(F.unix_micros("range_start") + F.lit(micros)))
    return joins.partitions_with_key(parts, v.tx, F.col("source_account_id") == 7)


@query("partitions_touched_6h", sql("tx", TOUCHED.format(hours=6)))
def partitions_touched_6h(v: Views):
    return _partitions_touched(v, 6)


@query("partitions_touched_week", sql("tx", TOUCHED.format(hours=168)))
def partitions_touched_week(v: Views):
    return _partitions_touched(v, 168)


@query(
    "partitions_touched",
    sql(
        "tx",
        """parts AS (SELECT date_trunc('day', created_at) AS range_start, count(*) AS n_rows FROM tx GROUP BY 1)
        SELECT range_start, range_start + INTERVAL 1 DAY AS range_end, n_rows FROM parts p
        WHERE EXISTS (SELECT 1 FROM tx t WHERE t.source_account_id = 7
          AND t.created_at >= p.range_start AND t.created_at < p.range_start + INTERVAL 1 DAY)""",
    ),
)
def partitions_touched(v: Views):
    parts = lifecycle.day_partitions(v.tx)
    return joins.partitions_with_key(parts, v.tx, F.col("source_account_id") == 7)


@query(
    "month_count_audit",
    sql(
        "tx live",
        """a AS (SELECT CAST(strftime(created_at, '%Y%m') AS INTEGER) AS m, count(*) AS n FROM tx GROUP BY 1),
        b AS (SELECT yyyymm AS m, count(*) AS n FROM live GROUP BY 1)
        SELECT m AS yyyymm, coalesce(a.n, 0) AS source_rows, coalesce(b.n, 0) AS target_rows,
          a.n IS DISTINCT FROM b.n AS differs
        FROM a FULL JOIN b USING (m)""",
    ),
)
def month_count_audit(v: Views):
    from paytide.functions.timing import month_key

    return joins.diff_counts(v.tx, v.live, month_key("created_at"), "yyyymm")


@query(
    "day_count_audit",
    sql(
        "tx live",
        """a AS (SELECT CAST(created_at AS DATE) AS day, count(*) AS n FROM tx GROUP BY 1),
        b AS (SELECT CAST(created_at AS DATE) AS day, count(*) AS n FROM live GROUP BY 1)
        SELECT day, coalesce(a.n, 0) AS source_rows, coalesce(b.n, 0) AS target_rows,
          a.n IS DISTINCT FROM b.n AS differs
        FROM a FULL JOIN b USING (day)""",
    ),
)
def day_count_audit(v: Views):
    return joins.diff_counts(v.tx, v.live, F.to_date("created_at"), "day")


@query(
    "orphan_rows",
    sql(
        "tx final",
        """SELECT tx_id, status, created_at FROM final f
        WHERE NOT EXISTS (SELECT 1 FROM tx t WHERE t.id = f.tx_id AND t.status <> 'reversed')""",
    ),
)
def orphan_rows(v: Views):
    """The source has physically lost its reversed rows; the mirror still holds them."""
    source = v.tx.filter(F.col("status") != "reversed")
    return joins.orphans(v.final, source, "tx_id", "id").select("tx_id", "status", "created_at")


@query(
    "ordered_array_pick",
    sql(
        "legacy_users tx",
        """arr AS (SELECT list(id ORDER BY id DESC) AS ids FROM legacy_users)
        SELECT t.id, ids[1 + t.id % len(ids)] AS picked FROM tx t, arr""",
    ),
)
def ordered_array_pick(v: Views):
    """``arr[1 + g % n]`` over an ordered array, as a join on dense positions."""
    ranked = with_position(v.legacy_users.select((-F.col("id")).alias("neg")), ["neg"])
    size = v.legacy_users.agg(F.count("*")).scalar()
    wanted = v.tx.select("id", (F.col("id") % size).alias("position"))
    return wanted.join(ranked, "position").select("id", (-F.col("neg")).alias("picked"))


@query(
    "ordered_string_agg",
    sql(
        "configs tx",
        """SELECT source_institution, string_agg(type, ', ' ORDER BY type) AS types
        FROM (SELECT DISTINCT source_institution, type FROM tx) GROUP BY 1""",
    ),
)
def ordered_string_agg(v: Views):
    names = v.tx.select("source_institution", "type").distinct()
    return names.groupBy("source_institution").agg(
        F.array_join(F.sort_array(F.collect_list("type")), ", ").alias("types")
    )


@query(
    "union_without_repeats",
    sql(
        "tx anchor",
        """SELECT id, updated_at FROM tx, anchor
        WHERE updated_at >= as_of - INTERVAL 2 DAY OR created_at >= as_of - INTERVAL 3 DAY""",
    ),
)
def union_without_repeats(v: Views):
    """Two overlapping windows joined by id, each row once."""
    from paytide.functions.timing import last
    from paytide.sources.increment import union_new

    rows = v.tx.select("id", "updated_at", "created_at")
    both = union_new(
        rows.filter(last("updated_at", "2 days", v.as_of)),
        rows.filter(last("created_at", "3 days", v.as_of)),
    )
    return both.select("id", "updated_at")


@query(
    "latest_row_per_key",
    sql(
        "tx",
        """SELECT source_account_id, id, created_at, status FROM tx
        QUALIFY row_number() OVER (PARTITION BY source_account_id ORDER BY created_at DESC, id DESC) = 1""",
    ),
)
def latest_row_per_key(v: Views):
    rows = v.tx.select("source_account_id", "id", "created_at", "status")
    return versions.latest(rows, ["source_account_id"], "created_at", ("id",))
