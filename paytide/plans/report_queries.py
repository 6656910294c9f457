"""Registered queries: answers as JSON documents, and jobs that leave a record of what they did."""

from __future__ import annotations

from pyspark.sql import functions as F

from paytide.functions.percentile import exact_percentiles
from paytide.functions.timing import interval, last
from paytide.operators import answers, lifecycle, states, versions, windows
from paytide.plans.aggregate_queries import HEALTH
from paytide.plans.join_queries import LOOSE
from paytide.plans.maintenance_queries import erasure_requests
from paytide.plans.oracle import sql
from paytide.plans.registry import query
from paytide.plans.views import Views
from paytide.session import stored, workspace


@query(
    "fraud_duplicates_json",
    sql(
        "live",
        """a AS (SELECT max(created_at) AS as_of FROM raw),
        w AS (SELECT *, lag(created_at) OVER (PARTITION BY source_account_id, type
               ORDER BY created_at, tx_id) AS previous_at
          FROM live, a WHERE created_at >= as_of - INTERVAL 168 HOUR),
        d AS (SELECT *, date_diff('second', previous_at, created_at) AS apart FROM w
          WHERE previous_at IS NOT NULL AND date_diff('second', previous_at, created_at) <= 900
          ORDER BY created_at DESC, tx_id DESC LIMIT 100)
        SELECT '{"window":"168h","duplicate_window_seconds":900,"anchor":"'
          || (SELECT strftime(as_of, '%Y-%m-%dT%H:%M:%S.%f') FROM a) || '","count":' || count(*) || ',"data":['
          || coalesce(string_agg('{"external_id":"' || external_id || '","tx_id":' || tx_id
             || ',"amount":' || CAST(CAST(amount AS DECIMAL(18,2)) AS VARCHAR)
             || ',"created_at":"' || strftime(created_at, '%Y-%m-%dT%H:%M:%S.%f') || '","status":"' || status
             || '","source_account_id":' || source_account_id || ',"destination_account_id":' || destination_account_id
             || ',"previous_at":"' || strftime(previous_at, '%Y-%m-%dT%H:%M:%S.%f')
             || '","seconds_apart":' || apart || '}', ',' ORDER BY created_at DESC, tx_id DESC), '') || ']}' AS payload
        FROM d""",
    ),
)
def fraud_duplicates_json(v: Views):
    hits = windows.fraud_duplicates(v.raw, v.as_of, hours=168, window_seconds=900, limit=100, keys=LOOSE)
    return answers.duplicates_answer(hits, 168, 900, v.as_of, 100)


@query(
    "institution_health_json",
    sql(
        "funnel dict anchor",
        "h AS ("
        + HEALTH.format(hours=24, where="")
        + """),
        p AS (SELECT source_institution AS institution,
            round(quantile_cont(CAST(settle_ms AS DOUBLE), 0.95) / 1000, 3) AS p95
          FROM final, anchor WHERE date_trunc('hour', created_at) >= as_of - INTERVAL 24 HOUR
            AND settle_ms IS NOT NULL GROUP BY 1)
        SELECT institution, '{"institution":"' || institution || '","institution_name":"' || institution_name
          || '","window":"24h","anchor":"' || strftime(as_of, '%Y-%m-%dT%H:%M:%S.%f') || '","total":' || total
          || ',"settled":' || settled || ',"failed":' || failed
          || ',"success_rate":' || CAST(CAST(success_rate AS DECIMAL(5,4)) AS VARCHAR)
          || ',"failure_rate":' || CAST(CAST(failure_rate AS DECIMAL(5,4)) AS VARCHAR)
          || ',"p95_settlement_seconds":' || coalesce(CAST(CAST(p95 AS DECIMAL(18,3)) AS VARCHAR), 'null')
          || ',"avg_settlement_seconds":' || coalesce(CAST(CAST(avg_settlement_seconds AS DECIMAL(18,3)) AS VARCHAR), 'null')
          || '}' AS payload
        FROM h LEFT JOIN p USING (institution), anchor""",
    ),
)
def institution_health_json(v: Views):
    """Health of the last day with the exact P95, one document per institution."""
    health = states.institution_health(v.funnel_since("24 hours"), v.dictionary, v.as_of, 24)
    cut = v.as_of - interval("24 hours")
    # whole hours, as the partial states have them
    recent = versions.final(v.raw.filter(F.col("created_at") >= F.date_trunc("hour", cut))).filter(
        last(F.date_trunc("hour", "created_at"), "24 hours", v.as_of) & F.col("settlement_seconds").isNotNull()
    )
    ms = F.round(F.col("settlement_seconds") * 1000).cast("long")
    found = exact_percentiles(
        recent.select(F.col("source_institution").alias("institution"), ms.alias("ms")), ["institution"], "ms", {"p95": 0.95}
    )
    p95 = found.select("institution", (F.col("p95") / 1000).alias("p95_settlement_seconds"))
    return answers.health_answers(health, 24, v.as_of, p95)


@query(
    "erasure_log_repeated",
    sql(
        "accounts erasures",
        """SELECT sha256(holder_document) AS document_hash, requested_at, executed_at, requester,
          CASE WHEN id % 100 = 0 THEN 0 ELSE 1 END AS affected_rows,
          executed_at < requested_at + INTERVAL 365 DAY AS backups_pending
        FROM erasures JOIN (SELECT id, CASE WHEN id % 100 = 0
          THEN 'ANON-' || sha256(CAST(id AS VARCHAR) || 'salt') ELSE holder_document END AS holder_document FROM accounts) a
        USING (id)""",
    ),
)
def erasure_log_repeated(v: Views):
    """Every request comes again a day later, and every second holder was blanked out long ago."""
    asked = erasure_requests(v)
    again = asked.withColumn("requested_at", F.col("requested_at") + interval("1 day"))
    done = lifecycle.anonymize(v.accounts, asked.filter(F.col("id") % 100 == 0), "salt")
    return lifecycle.erasure_log(again.unionByName(asked), done, v.as_of)


@query(
    "audited_read_logged",
    sql(
        "accounts",
        """n AS (SELECT count(*) FILTER (WHERE institution_code = '003') AS of_one, count(*) AS of_all FROM accounts)
        SELECT 'ana' AS db_user, 'support case' AS purpose,
          'read_accounts_audited(institution=003, limit=100)' AS query_text,
          CAST(least(of_one, 100) AS INTEGER) AS rows_returned, CAST(least(of_one, 100) AS BIGINT) AS rows_read FROM n
        UNION ALL SELECT 'rui', 'yearly audit', 'read_accounts_audited(institution=TODAS, limit=50)',
          CAST(least(of_all, 50) AS INTEGER), CAST(least(of_all, 50) AS BIGINT) FROM n""",
    ),
)
def audited_read_logged(v: Views):
    """Two reads of personal data: what the log tells beside what went out."""
    log, now = workspace(v.spark, "reads"), v.table("events").agg(F.max("ts")).head()[0]
    some = lifecycle.read_accounts_audited(v.accounts, "support case", log, now, "ana", "003", 100)
    every = lifecycle.read_accounts_audited(v.accounts, "yearly audit", log, now, "rui", None, 50)
    read = F.when(F.col("db_user") == "ana", some.agg(F.count("*")).scalar()).otherwise(
        every.agg(F.count("*")).scalar()
    )
    entries = v.spark.read.schema(lifecycle.AUDIT_SCHEMA).parquet(log)
    return entries.select("db_user", "purpose", "query_text", "rows_returned", read.alias("rows_read"))


@query(
    "recovery_proven",
    sql(
        "tx anchor",
        """b AS (SELECT type, id, amount, created_at < as_of - INTERVAL 1 DAY AS old FROM tx, anchor),
        s AS (SELECT 'clean' AS name, *, old AS kept FROM b
          UNION ALL SELECT 'botched', *, CASE WHEN old THEN id % 13 <> 0 ELSE id % 17 = 0 END FROM b)
        SELECT name, type, count(*) FILTER (WHERE old) AS n_before,
          CAST(sum(amount) FILTER (WHERE old) AS DOUBLE) AS total_before,
          count(*) FILTER (WHERE kept) AS n_after, CAST(sum(amount) FILTER (WHERE kept) AS DOUBLE) AS total_after,
          count(*) FILTER (WHERE old AND NOT kept) AS missing, count(*) FILTER (WHERE kept AND NOT old) AS residue,
          0::BIGINT AS changed, count(*) FILTER (WHERE old <> kept) = 0 AS proven
        FROM s GROUP BY ALL HAVING count(*) FILTER (WHERE old OR kept) > 0""",
    ),
)
def recovery_proven(v: Views):
    """Two stored recoveries to a point a day back: a whole one, and one with gaps and later rows."""
    point = v.ago("1 day")
    old = F.col("created_at") < point
    rows = v.tx.select("id", "type", "amount", "created_at")
    gaps = F.when(old, F.col("id") % 13 != 0).otherwise(F.col("id") % 17 == 0)
    out = None
    for name, kept in (("clean", old), ("botched", gaps)):
        proof = lifecycle.recovery_proof(v.tx, stored(rows.filter(kept), "recovered"), "type", "id", point)
        proof = proof.withColumn("name", F.lit(name))
        out = proof if out is None else out.unionByName(proof)
    return out


@query(
    "recluster_ratio",
    sql(
        "tx",
        """SELECT count(*) AS n_rows_before, count(*) AS n_rows_after, 8::BIGINT AS files_after,
          true AS has_bytes, true AS ratio_holds FROM tx""",
    ),
)
def recluster_ratio(v: Views):
    """Rows and bytes before and after the clustered rewrite of a stored table.

    Whether it shrinks depends on the data: in a thousand rows the footers of the files outweigh it.
    """
    before, path = stored(v.tx.repartition("id"), "plain"), workspace(v.spark, "clustered")
    lifecycle.recluster(before, path, files=8)
    report = lifecycle.recluster_report(before, v.spark.read.schema(before.schema).parquet(path))
    close = F.abs(F.col("ratio") * F.col("bytes_after") - F.col("bytes_before")) < 1
    full = (F.col("bytes_before") > 0) & (F.col("bytes_after") > 0)
    return report.select(
        "n_rows_before", "n_rows_after", "files_after", full.alias("has_bytes"), close.alias("ratio_holds")
    )
