"""Live quotes: one landed ``live_navps`` body -> one row of prices per fund.

Every function is a single projection over the landing rows, without any shuffle. The
vendor functions keep all fields of their payload; ``live_quotes`` reads all vendors in one
scan and keeps the common ones. A body that does not parse gives nulls; when ``strict``, it is an error, as
is a quote without prices or time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundlake import constants as C
from fundlake import schemas as S
from fundlake.functions import dates, jalali, text
from fundlake.functions.rows import keep_where
from fundlake.sources.landing import captured
from fundlake.sources.payload import decode_json_string, from_json

ENDPOINT = "live_navps"
KEEP = [*S.KEY, "fetched_at"]


def _parsed(responses: DataFrame, vendors: list[str], payload: Column) -> DataFrame:
    rows = captured(responses, ENDPOINT, vendors)
    return rows.select(*KEEP, payload.alias("q"))


def _required(strict: bool, **columns: Column) -> list[Column]:
    """The named columns; when ``strict``, a null in one of them is an error."""
    if strict:
        columns = {
            name: F.coalesce(c, F.raise_error(F.lit(f"quote without {name}")))
            for name, c in columns.items()
        }
    return [c.alias(name) for name, c in columns.items()]


def tadbir_quotes(responses: DataFrame, strict: bool = False) -> DataFrame:
    """Double-encoded JSON; ten whole numbers, two texts, a Jalali publishing time."""
    payload = from_json(decode_json_string(F.col("body")), S.TADBIR_QUOTE, strict)
    q = _parsed(responses, [C.TADBIR, C.TADBIR_MULTI], payload)
    prices = ["creation", "redemption", "nominal"]
    return q.select(
        *KEEP,
        *[
            text.to_whole(F.col(f"q.{source}"), strict).alias(name)
            for source, name in S.TADBIR_QUOTE_WHOLE.items()
            if name not in prices
        ],
        *_required(
            strict,
            **{
                name: text.to_whole(F.col(f"q.{source}"), strict)
                for source, name in S.TADBIR_QUOTE_WHOLE.items()
                if name in prices
            },
        ),
        *[F.col(f"q.{name}") for name in S.TADBIR_QUOTE_TEXT],
        *_required(strict, date=jalali.to_timestamp(F.col("q.publishDate"), strict)),
    )


def leveraged_quotes(responses: DataFrame, strict: bool = False) -> DataFrame:
    """Base and super units of a leveraged fund; the super unit gives the prices."""
    payload = from_json(decode_json_string(F.col("body")), S.LEVERAGED_QUOTE, strict)
    q = _parsed(responses, [C.TADBIR_LEVERAGED], payload)
    return q.select(
        *KEEP,
        *_required(
            strict,
            **{name: text.to_double(F.col(f"q.{name}"), strict) for name in S.LEVERAGED_QUOTE_DOUBLE},
            creation=text.to_whole(F.col("q.SuperUnitsSubscriptionNAV"), strict),
            redemption=text.to_whole(F.col("q.SuperUnitsCancelNAV"), strict),
        ),
        *[
            text.to_bigint(F.col(f"q.{source}"), strict).alias(name)
            for source, name in S.LEVERAGED_QUOTE_WHOLE.items()
            if name not in ("creation", "redemption")
        ],
        *_required(strict, date=jalali.to_timestamp(F.col("q.PublishDate"), strict)),
    )


def _rayan_payloads(body: Column) -> tuple[Column, Column]:
    """The vendor's record in its newer and its older spelling."""
    return from_json(body, S.RAYAN2_QUOTE).alias("new"), from_json(body, S.RAYAN_QUOTE).alias("old")


def _rayan_creation() -> Column:
    return F.coalesce("new.purchaseNav", "old.PurchaseNav")


def _rayan_redemption() -> Column:
    return F.coalesce("new.saleNav", "old.SaleNav")


def _rayan_time() -> Column:
    space = F.lit(" ")
    return F.coalesce(
        F.concat("new.date", space, "new.time"), F.concat("old.Date", space, "old.Time")
    )


def rayan_quotes(responses: DataFrame, strict: bool = False) -> DataFrame:
    rows = captured(responses, ENDPOINT, C.RAYAN_FAMILY)
    parsed = rows.select(*KEEP, *_rayan_payloads(F.col("body")))
    return parsed.select(
        *KEEP,
        *_required(
            strict,
            creation=_rayan_creation(),
            redemption=_rayan_redemption(),
            date=jalali.to_timestamp(_rayan_time(), strict),
        ),
    )


def mabna_quotes(responses: DataFrame, strict: bool = False) -> DataFrame:
    q = _parsed(responses, [C.MABNA], from_json(F.col("body"), S.MABNA_QUOTE, strict))
    return q.select(
        *KEEP,
        *_required(
            strict,
            creation=F.col("q.data.purchase_price"),
            redemption=F.col("q.data.redemption_price"),
            date=dates.wall_clock(F.col("q.data.date_time"), strict),
        ),
    )


def live_quotes(responses: DataFrame) -> DataFrame:
    """All vendors' quotes as ``(fund, fetched_at, creation, redemption, date)``.

    Each body is parsed once, with its own vendor's schema, before any field is used.
    """
    rows = captured(responses, ENDPOINT)
    site_type, body = F.col("site_type"), F.col("body")
    tadbir = site_type.isin(C.TADBIR, C.TADBIR_MULTI)
    leveraged = site_type == C.TADBIR_LEVERAGED
    rayan = site_type.isin(*C.RAYAN_FAMILY)
    mabna = site_type == C.MABNA
    decoded = F.when(tadbir | leveraged, decode_json_string(body)).alias("inner")
    new, old = _rayan_payloads(F.when(rayan, body))
    parsed = rows.select(
        *KEEP, decoded, new, old, from_json(F.when(mabna, body), S.MABNA_QUOTE).alias("m")
    ).select(
        *KEEP,
        "new",
        "old",
        "m",
        from_json(F.when(tadbir, F.col("inner")), S.TADBIR_QUOTE).alias("t"),
        from_json(F.when(leveraged, F.col("inner")), S.LEVERAGED_QUOTE).alias("l"),
    )

    def price(of_tadbir, of_leveraged, of_rayan, of_mabna):
        return F.coalesce(
            text.to_whole(F.col(of_tadbir), strict=False).cast("double"),
            text.to_bigint(F.col(of_leveraged), strict=False).cast("double"),
            of_rayan,
            of_mabna,
        )

    common = parsed.select(
        *KEEP,
        price(
            "t.subNav", "l.SuperUnitsSubscriptionNAV", _rayan_creation(), "m.data.purchase_price"
        ).alias("creation"),
        price(
            "t.cancelNav", "l.SuperUnitsCancelNAV", _rayan_redemption(), "m.data.redemption_price"
        ).alias("redemption"),
        F.coalesce("t.publishDate", "l.PublishDate", _rayan_time()).alias("jalali_time"),
        F.col("m.data.date_time").alias("iso_time"),
    )
    published = F.coalesce(
        jalali.to_timestamp(F.col("jalali_time"), strict=False),
        dates.wall_clock(F.col("iso_time"), strict=False),
    )
    return common.select(*KEEP, "creation", "redemption", published.alias("date"))


def polls(responses: DataFrame) -> DataFrame:
    """Captures of the vendors that say when to ask next: ``(fund, fetched_at, next_ms)``.

    ``next_ms`` is the vendor's ``nextTimeInterval`` in milliseconds; null if the answer has none.
    """
    rows = captured(responses, ENDPOINT, C.RAYAN_FAMILY)
    parsed = rows.select(*KEEP, *_rayan_payloads(F.col("body")))
    return parsed.select(*KEEP, F.coalesce("new.nextTimeInterval", "old.NextTimeInterval").alias("next_ms"))


def polling_runs(polled: DataFrame, otherwise_ms: int = 60_000, late: str | None = None) -> DataFrame:
    """Unbroken polling per fund: ``(fund, first_poll, last_poll, expected, polls)``.

    A run goes on while the next poll comes before the time that any poll of the run named,
    ``expected`` being the last such time; polls that name none (or none in the future) count
    as ``otherwise_ms``. In a stream, ``late`` is how far captures may come behind the newest.
    """
    hint = F.when(F.col("next_ms") > 0, F.col("next_ms")).otherwise(F.lit(otherwise_ms))
    timed = polled if late is None else polled.withWatermark("fetched_at", late)
    gap = F.concat((hint / 1000).cast("decimal(20,3)").cast("string"), F.lit(" seconds"))
    runs = timed.groupBy(*S.KEY, F.session_window("fetched_at", gap).alias("run"))
    found = runs.agg(F.max("fetched_at").alias("last_poll"), F.count("*").alias("polls"))
    return found.select(*S.KEY, F.col("run.start").alias("first_poll"), "last_poll", F.col("run.end").alias("expected"), "polls")


def is_complete(quote: DataFrame) -> Column:
    """A quote counts as parsed when both prices and the time are there."""
    return (
        quote["creation"].isNotNull() & quote["redemption"].isNotNull() & quote["date"].isNotNull()
    )


def latest_quotes(quotes: DataFrame) -> DataFrame:
    """Newest quote per fund; partial maxima are taken before the shuffle."""
    fields = F.struct("date", "fetched_at", "creation", "redemption")
    dated = keep_where(quotes, F.col("date").isNotNull())
    newest = dated.groupBy(*S.KEY).agg(F.max(fields).alias("q"))
    return newest.select(*S.KEY, "q.*")
