"""Live quotes of all vendors, vendor trials, and the newest quote per fund."""

from __future__ import annotations

from pyspark.sql import functions as F

from fundlake import constants as C
from fundlake.functions import jalali, text
from fundlake.operators import quotes as Q
from fundlake.operators.sites import probed_sites, vendor_by_trial
from fundlake.session import shared_folder
from fundlake.streaming.quote_stream import (
    keep_latest,
    quote_stream,
    read_landing_stream,
    read_latest,
    read_quotes,
    write_quotes,
)
from workloads.encode import cents, fa, fa_commas, json_text, landed, site_url, time_text
from workloads.registry import query


def clock(seconds):
    parts = [
        F.call_function("div", seconds, F.lit(3600)),
        F.pmod(F.call_function("div", seconds, F.lit(60)), F.lit(60)),
        F.pmod(seconds, F.lit(60)),
    ]
    return F.concat_ws(":", *[F.lpad(p.cast("string"), 2, "0") for p in parts])


def day_of(key: str):
    return F.date_add(F.lit("2020-01-01").cast("date"), F.pmod(F.col(key), F.lit(1500)).cast("int"))


_SQL_TIME = """strftime(CAST(DATE '2020-01-01' + CAST({k} % 1500 AS INTEGER) AS TIMESTAMP)
    + to_seconds({seconds}), '%Y-%m-%d %H:%M:%S')"""


@query(
    "live_quote_double_json",
    f"""
    SELECT c_custkey, CAST(round(c_acctbal * 100) AS BIGINT) + 5 AS creation,
      CAST(round(c_acctbal * 100) AS BIGINT) AS redemption,
      CAST(round(c_acctbal * 100) AS BIGINT) + 1 AS nominal,
      c_custkey * 1000003 AS total_unit, c_custkey * 1000000007 AS total_value,
      CAST(c_custkey AS VARCHAR) || ',0' AS max_unit,
      {_SQL_TIME.format(k="c_custkey",
        seconds="CASE WHEN c_custkey % 4 = 0 THEN 0 ELSE c_custkey * 37 % 86400 END")} AS quoted_at
    FROM customer
    """,
)
def live_quote_double_json(t):
    key, c = F.col("c_custkey"), cents("c_acctbal")
    jalali_day = text.persian_digits(jalali.from_date(day_of("c_custkey")))
    seconds = F.pmod(key * 37, F.lit(86400))
    time = F.when(key % 4 == 0, F.lit("")).otherwise(fa(clock(seconds)))
    zero = F.lit("۰")
    inner = F.to_json(
        F.struct(
            fa_commas(c + 5).alias("subNav"),
            fa_commas(c).alias("cancelNav"),
            fa_commas(c + 1).alias("esmiNav"),
            F.concat(jalali_day, F.lit(" "), time).alias("publishDate"),
            F.concat(key.cast("string"), F.lit(",0")).alias("maxUnit"),
            F.format_number(key * 1000003, 0).alias("totalUnit"),
            fa_commas(key * 1000000007).alias("totalNetAssetValue"),
            F.lit("1402/08/30").alias("navDate"),
            zero.alias("finalSubscriptionNAV"),
            zero.alias("finalCancelNAV"),
            zero.alias("finalEsmiNAV"),
            zero.alias("dailyTotalUnit"),
            zero.alias("dailyTotalNetAssetValue"),
        )
    )
    rows = landed(
        t.customer,
        F.when(key % 2 == 0, F.lit(C.TADBIR)).otherwise(F.lit(C.TADBIR_MULTI)),
        F.lit("http://sector.example.ir/"),
        Q.ENDPOINT,
        json_text(inner),
        portfolio_id=key,
    )
    q = Q.tadbir_quotes(rows)
    return q.select(
        F.col("portfolio_id").cast("bigint").alias("c_custkey"),
        "creation",
        "redemption",
        "nominal",
        F.col("totalUnit").alias("total_unit"),
        F.col("totalNetAssetValue").alias("total_value"),
        F.col("maxUnit").alias("max_unit"),
        time_text("date").alias("quoted_at"),
    )


def tadbir_body(key: str, balance: str):
    """The double-encoded quote with the prices and the time only, at a second past midnight of the key."""
    k, c = F.col(key), cents(balance)
    day = text.persian_digits(jalali.from_date(day_of(key)))
    published = F.concat(day, F.lit(" "), fa(clock(F.pmod(k * 11, F.lit(86400)))))
    prices = [fa_commas(c + 3).alias("subNav"), fa_commas(c).alias("cancelNav"), fa_commas(c + 1).alias("esmiNav")]
    return json_text(F.to_json(F.struct(*prices, published.alias("publishDate"))))


def leveraged_body(key: str, balance: str):
    """Leveraged quote in which the base amount is a quarter of key units over the super one."""
    k, c = F.col(key), cents(balance)
    inner = F.to_json(
        F.struct(
            F.concat(fa_commas(k + 1000), F.lit(".۵")).alias("BaseUnitsCancelNAV"),
            F.concat(fa_commas(k * 2 + 1), F.lit(".25")).alias("BaseUnitsTotalNetAssetValue"),
            fa_commas(k * 1000).alias("BaseUnitsTotalSubscription"),
            fa_commas(c).alias("SuperUnitsCancelNAV"),
            fa_commas(c + 9).alias("SuperUnitsSubscriptionNAV"),
            fa_commas(k * 3000).alias("SuperUnitsTotalSubscription"),
            fa_commas(k + 16).alias("SuperUnitsTotalNetAssetValue"),
            F.concat(
                fa(jalali.from_date(day_of(key))), F.lit(" "), fa(clock(F.pmod(k, F.lit(86400))))
            ).alias("PublishDate"),
        )
    )
    return json_text(inner)


@query(
    "live_quote_leveraged",
    f"""
    SELECT s_suppkey, CAST(s_suppkey + 1000.5 AS DOUBLE) AS base_cancel,
      CAST(s_suppkey * 2 + 1.25 AS DOUBLE) AS base_total,
      CAST(s_suppkey + 16 AS DOUBLE) AS super_total, s_suppkey * 1000 AS base_units,
      s_suppkey * 3000 AS super_units, CAST(round(s_acctbal * 100) AS BIGINT) AS redemption,
      CAST(round(s_acctbal * 100) AS BIGINT) + 9 AS creation,
      {_SQL_TIME.format(k="s_suppkey", seconds="s_suppkey % 86400")} AS quoted_at
    FROM supplier
    """,
)
def live_quote_leveraged(t):
    rows = landed(
        t.supplier,
        C.TADBIR_LEVERAGED,
        site_url("lever", "s_suppkey"),
        Q.ENDPOINT,
        leveraged_body("s_suppkey", "s_acctbal"),
        portfolio_id=F.col("s_suppkey"),
    )
    q = Q.leveraged_quotes(rows)
    return q.select(
        F.col("portfolio_id").cast("bigint").alias("s_suppkey"),
        F.col("BaseUnitsCancelNAV").alias("base_cancel"),
        F.col("BaseUnitsTotalNetAssetValue").alias("base_total"),
        F.col("SuperUnitsTotalNetAssetValue").alias("super_total"),
        F.col("BaseUnitsTotalSubscription").alias("base_units"),
        F.col("SuperUnitsTotalSubscription").alias("super_units"),
        "redemption",
        "creation",
        time_text("date").alias("quoted_at"),
    )


def rayan_body(key: str, balance: str, capital: bool):
    names = ["fundId", "fundNavId", "purchaseNav", "saleNav", "date", "time"]
    if capital:
        names = [n[0].upper() + n[1:] for n in names]
    k, c = F.col(key), cents(balance)
    values = [
        k,
        k + 7,
        c + 3,
        c,
        jalali.from_date(day_of(key)),
        clock(F.pmod(k * 11, F.lit(86400))),
    ]
    return F.to_json(F.struct(*[v.alias(n) for v, n in zip(values, names)]))


def mabna_body(key: str, balance: str):
    k, c = F.col(key), cents(balance)
    at = F.concat(
        day_of(key).cast("string"), F.lit("T"), clock(F.pmod(k * 11, F.lit(86400))), F.lit("+03:30")
    )
    record = F.struct(
        c.alias("redemption_price"), (c + 3).alias("purchase_price"), at.alias("date_time")
    )
    return F.to_json(F.struct(record.alias("data")))


def three_vendor_quotes(suppliers):
    """Every supplier as a fund of three vendors, in three spellings."""
    vendors = F.array(F.lit(C.RAYAN), F.lit(C.RAYAN2), F.lit(C.MABNA))
    rows = suppliers.withColumn("vendor", F.explode(vendors))
    body = (
        F.when(F.col("vendor") == C.RAYAN, rayan_body("s_suppkey", "s_acctbal", True))
        .when(F.col("vendor") == C.RAYAN2, rayan_body("s_suppkey", "s_acctbal", False))
        .otherwise(mabna_body("s_suppkey", "s_acctbal"))
    )
    return landed(
        rows,
        F.col("vendor"),
        F.lit("http://hot.example.ir/"),
        Q.ENDPOINT,
        body,
        portfolio_id=F.col("s_suppkey"),
    )


_QUOTE_SQL = f"""
    SELECT s_suppkey, site_type, CAST(round(s_acctbal * 100) AS DOUBLE) + 3 AS creation,
      CAST(round(s_acctbal * 100) AS DOUBLE) AS redemption,
      {_SQL_TIME.format(k="s_suppkey", seconds="s_suppkey * 11 % 86400")} AS quoted_at
    FROM supplier, (VALUES {{vendors}}) v(site_type)
"""


def _common(quotes):
    return quotes.select(
        F.col("portfolio_id").cast("bigint").alias("s_suppkey"),
        "site_type",
        F.col("creation").cast("double").alias("creation"),
        F.col("redemption").cast("double").alias("redemption"),
        time_text("date").alias("quoted_at"),
    )


@query(
    "live_quote_json",
    _QUOTE_SQL.format(vendors="('RayanHamafza'), ('RayanHamafza2'), ('MabnaDP2')"),
)
def live_quote_json(t):
    rows = three_vendor_quotes(t.supplier)
    return _common(Q.rayan_quotes(rows).unionByName(Q.mabna_quotes(rows)))


@query(
    "live_quote_all_vendors",
    _QUOTE_SQL.format(vendors="('RayanHamafza'), ('RayanHamafza2'), ('MabnaDP2')")
    + f"""
    UNION ALL
    SELECT s_suppkey, 'LeveragedTadbirPardaz', CAST(round(s_acctbal * 100) AS DOUBLE) + 9,
      CAST(round(s_acctbal * 100) AS DOUBLE),
      {_SQL_TIME.format(k="s_suppkey", seconds="s_suppkey % 86400")}
    FROM supplier
    UNION ALL
    SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN '{C.TADBIR}' ELSE '{C.TADBIR_MULTI}' END,
      CAST(round(s_acctbal * 100) AS DOUBLE) + 3, CAST(round(s_acctbal * 100) AS DOUBLE),
      {_SQL_TIME.format(k="s_suppkey", seconds="s_suppkey * 11 % 86400")}
    FROM supplier
    """,
)
def live_quote_all_vendors(t):
    leveraged = landed(
        t.supplier,
        C.TADBIR_LEVERAGED,
        site_url("lever", "s_suppkey"),
        Q.ENDPOINT,
        leveraged_body("s_suppkey", "s_acctbal"),
        portfolio_id=F.col("s_suppkey"),
    )
    tadbir = landed(
        t.supplier,
        F.when(F.col("s_suppkey") % 2 == 0, F.lit(C.TADBIR)).otherwise(F.lit(C.TADBIR_MULTI)),
        site_url("tadbir", "s_suppkey"),
        Q.ENDPOINT,
        tadbir_body("s_suppkey", "s_acctbal"),
        portfolio_id=F.col("s_suppkey"),
    )
    return _common(Q.live_quotes(three_vendor_quotes(t.supplier).unionByName(leveraged).unionByName(tadbir)))


@query(
    "vendor_by_trial",
    """
    SELECT 'c' || c_custkey || '.example.ir' AS domain,
      'http://c' || c_custkey || '.example.ir/' AS url,
      CASE WHEN c_custkey % 2 = 0 THEN 'RayanHamafza2' WHEN c_custkey % 7 = 0 THEN 'TadbirPardaz'
        WHEN c_custkey % 3 = 0 THEN 'LeveragedTadbirPardaz' ELSE 'MabnaDP2' END AS site_type
    FROM customer WHERE c_custkey % 2 = 0 OR c_custkey % 7 = 0 OR c_custkey % 3 = 0 OR c_custkey % 5 <> 0
    """,
)
def trials(t):
    return vendor_by_trial(trial_responses(t).unionByName(outdated_trials(t)))


def outdated_trials(t):
    """A quote that every site once gave in the first vendor's form, a year before the others."""
    url = F.concat(site_url("c", "c_custkey"), F.lit("api/v1/quote?x=1"))
    body = rayan_body("c_custkey", "c_acctbal", False)
    at = F.lit("2023-01-01 00:00:00").cast("timestamp")
    return landed(t.customer, C.RAYAN2, url, Q.ENDPOINT, body, at=at)


def trial_responses(t):
    """Quotes of every customer's site as four vendors were asked for them; some are broken."""
    key = F.col("c_custkey")
    tried = t.customer.withColumn("vendor", F.explode(F.array(*[F.lit(v) for v in C.TRIAL_ORDER])))
    vendor = F.col("vendor")
    broken = F.lit("<html>not found</html>")
    body = (
        F.when(
            vendor == C.RAYAN2,
            F.when(key % 2 == 0, rayan_body("c_custkey", "c_acctbal", False)).otherwise(broken),
        )
        .when(
            vendor == C.TADBIR_LEVERAGED,
            F.when(key % 3 == 0, leveraged_body("c_custkey", "c_acctbal")).otherwise(broken),
        )
        .when(
            vendor == C.MABNA,
            F.when(key % 5 != 0, mabna_body("c_custkey", "c_acctbal")).otherwise(F.lit("{}")),
        )
        .otherwise(F.when(key % 7 == 0, tadbir_body("c_custkey", "c_acctbal")).otherwise(broken))
    )
    url = F.concat(site_url("c", "c_custkey"), F.lit("api/v1/quote?x=1"))
    return landed(tried, vendor, url, Q.ENDPOINT, body)


@query(
    "probed_sites",
    """
    SELECT 'c' || c_custkey || '.example.ir' AS domain,
      'http://c' || c_custkey || '.example.ir/' AS url,
      CASE WHEN c_nationkey < 8 THEN 'TadbirPardaz' WHEN c_custkey % 2 = 0 THEN 'RayanHamafza2'
        WHEN c_custkey % 7 = 0 THEN 'TadbirPardaz' WHEN c_custkey % 3 = 0 THEN 'LeveragedTadbirPardaz' ELSE 'MabnaDP2' END AS site_type
    FROM customer
    WHERE c_nationkey < 8 OR c_custkey % 2 = 0 OR c_custkey % 7 = 0 OR c_custkey % 3 = 0 OR c_custkey % 5 <> 0
    """,
)
def probes_of_sites(t):
    """Customers of some nations have a marked home page; the others are told by trial, whatever older pages had."""
    page = F.when(F.col("c_nationkey") < 8, F.lit(C.TADBIR_MARKER)).otherwise(F.lit("<html>"))
    homes = landed(t.customer, "", site_url("c", "c_custkey"), "home", page)
    at = F.lit("2023-06-01 00:00:00").cast("timestamp")
    older = landed(t.customer, "", site_url("c", "c_custkey"), "home", F.lit(C.RAYAN2_MARKER), at=at)
    trials = trial_responses(t).unionByName(outdated_trials(t))
    return probed_sites(homes.unionByName(older).unionByName(trials))


def event_quotes(t):
    """Every event as a landed quote of its user's fund."""
    at = F.col("ts")
    record = F.struct(
        cents("value").alias("redemption_price"),
        (cents("value") + F.col("event_id") % 7).alias("purchase_price"),
        F.concat(F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+03:30")).alias("date_time"),
    )
    return landed(
        t.events,
        C.MABNA,
        site_url("user", "user_id"),
        Q.ENDPOINT,
        F.to_json(F.struct(record.alias("data"))),
    )


_LATEST = """
    WITH q AS (
      SELECT user_id, date_trunc('second', ts) AS at_time,
        CAST(round(value * 100) AS DOUBLE) + event_id % 7 AS creation,
        CAST(round(value * 100) AS DOUBLE) AS redemption
      FROM events
    )
    SELECT 'http://user' || user_id || '.example.ir/' AS url,
      strftime(at_time, '%Y-%m-%d %H:%M:%S') AS quoted_at, creation, redemption
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id
      ORDER BY at_time DESC, creation DESC, redemption DESC) AS n FROM q) WHERE n = 1
"""


@query("latest_quote", _LATEST)
def latest_quote(t):
    newest = Q.latest_quotes(Q.live_quotes(event_quotes(t)))
    return newest.select("url", time_text("date").alias("quoted_at"), "creation", "redemption")


def landed_events(t) -> str:
    """Events landed as files in a fresh shared folder; returns the folder."""
    base = shared_folder(t.spark, "quote-stream")
    event_quotes(t).write.parquet(f"{base}/landing")
    return base


@query(
    "quote_stream",
    """
    SELECT 'http://user' || user_id || '.example.ir/' AS url,
      strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS quoted_at,
      arg_min(c, [c, r]) AS creation, min(r) FILTER (c = least_c) AS redemption
    FROM (
      SELECT *, min(c) OVER (PARTITION BY user_id, date_trunc('second', ts)) AS least_c
      FROM (SELECT *, CAST(round(value * 100) AS DOUBLE) + event_id % 7 AS c, CAST(round(value * 100) AS DOUBLE) AS r FROM events))
    GROUP BY user_id, date_trunc('second', ts)
    """,
)
def streamed_quotes(t):
    """Landed events read back as a stream until used up, then landed once more; each quote once."""
    base = landed_events(t)

    def drain():
        stream = quote_stream(read_landing_stream(t.spark, f"{base}/landing"))
        write_quotes(stream, f"{base}/quotes", f"{base}/checkpoint").awaitTermination()

    drain()
    event_quotes(t).write.mode("append").parquet(f"{base}/landing")
    drain()
    return read_quotes(t.spark, f"{base}/quotes").select("url", time_text("date").alias("quoted_at"), "creation", "redemption")


@query(
    "polling_gaps",
    """
    WITH p AS (
      SELECT user_id, ts, ts + (1800 * (event_id % 24 + 1)) * INTERVAL 1 SECOND AS until FROM events),
    m AS (
      SELECT *, max(until) OVER (PARTITION BY user_id ORDER BY ts, until ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM p),
    n AS (
      SELECT *, sum(CASE WHEN reach IS NULL OR ts > reach THEN 1 ELSE 0 END)
        OVER (PARTITION BY user_id ORDER BY ts, until ROWS UNBOUNDED PRECEDING) AS run FROM m)
    SELECT 'http://user' || user_id || '.example.ir/' AS url, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS first_poll,
      strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_poll, strftime(max(until), '%Y-%m-%d %H:%M:%S') AS expected, count(*) AS polls
    FROM n GROUP BY user_id, run
    """,
)
def polling_gaps(t):
    """Every event as a poll whose answer says when to ask next; the runs end where nobody asked in time."""
    hint = 1_800_000 * (F.col("event_id") % 24 + 1)
    new = F.to_json(F.struct(hint.alias("nextTimeInterval"), F.lit(1).alias("fundId")))
    old = F.to_json(F.struct(hint.alias("NextTimeInterval"), F.lit(1).alias("FundId")))
    body = F.when(F.col("user_id") % 2 == 0, new).otherwise(old)
    vendor = F.when(F.col("user_id") % 2 == 0, F.lit(C.RAYAN2)).otherwise(F.lit(C.RAYAN))
    url = site_url("user", "user_id")
    polled = landed(t.events, vendor, url, Q.ENDPOINT, body, at=F.col("ts").cast("timestamp"))
    runs = Q.polling_runs(Q.polls(polled))
    return runs.select("url", *[time_text(c).alias(c) for c in ("first_poll", "last_poll", "expected")], "polls")


@query("latest_quote_stream", _LATEST)
def latest_quote_stream(t):
    """Newest quote per fund kept by a stream over several batches of landed events."""
    base = landed_events(t)
    stream = Q.live_quotes(read_landing_stream(t.spark, f"{base}/landing", files_per_trigger=4))
    keep_latest(stream, f"{base}/latest", f"{base}/checkpoint").awaitTermination()
    newest = read_latest(t.spark, f"{base}/latest")
    return newest.select("url", time_text("date").alias("quoted_at"), "creation", "redemption")
