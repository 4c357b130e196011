"""Asset allocation, cash ratio and leverage.

An allocation body is one small list, so the weights and the cash ratio come out of the row
itself; only leverage, which needs a second response of the same fund, shuffles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundlake import constants as C
from fundlake import schemas as S
from fundlake.functions import jalali, text
from fundlake.functions.rows import exploded, keep_where
from fundlake.operators.lookup import lookup_join
from fundlake.sources import records
from fundlake.sources.landing import captured, status_error
from fundlake.sources.payload import decode_json_string, from_json, read_records, script_state

ENDPOINT = "asset_allocation"
_ENTRY = "array<struct<item: string, weight: double>>"
_DATE_ITEMS = ["JalaliDate", "jalaliDate"]


def _vendor_lists(tadbir: list, mabna: list, rayan: list, rayan2: list) -> list[tuple]:
    return [
        (C.TADBIR_FAMILY, tadbir),
        ([C.MABNA], mabna),
        ([C.RAYAN], rayan),
        ([C.RAYAN2], rayan2),
    ]


def known_item(site_type: Column, item: Column) -> Column:
    """Whether the vendor is known to send the item."""
    known = F.lit(False)
    lists = _vendor_lists(C.TADBIR_ITEMS, C.MABNA_ITEMS, C.RAYAN_ITEMS, C.RAYAN2_ITEMS)
    for vendors, items in lists:
        known = F.when(site_type.isin(*vendors), item.isin(*items)).otherwise(known)
    return known


def entries(site_type: Column, body: Column) -> Column:
    """Payload of any vendor -> array of ``(item, weight)`` in payload order, as fractions."""

    def entry(item, percent):
        return F.struct(item.alias("item"), (percent / 100).alias("weight"))

    listed = F.transform(
        from_json(body, S.TADBIR_ALLOCATION)["List"], lambda e: entry(e["x"], e["y"])
    )
    assets = F.transform(
        from_json(body, S.MABNA_ALLOCATION)["data"]["assets"],
        lambda e: entry(e["title"], e["percentage"]),
    )
    wide = F.transform(
        F.filter(
            F.map_entries(from_json(body, "map<string, string>")),
            lambda e: ~e["key"].isin(*_DATE_ITEMS),
        ),
        lambda e: entry(e["key"], e["value"].try_cast("double")),
    )
    return (
        F.when(site_type.isin(*C.TADBIR_FAMILY), listed.cast(_ENTRY))
        .when(site_type == C.MABNA, assets.cast(_ENTRY))
        .when(site_type.isin(*C.RAYAN_FAMILY), wide.cast(_ENTRY))
    )


def date_text(site_type: Column, body: Column) -> Column:
    """Date that a wide allocation record carries, as it was sent."""
    record = from_json(body, "map<string, string>")
    value = F.coalesce(*[F.try_element_at(record, F.lit(name)) for name in _DATE_ITEMS])
    return F.when(site_type.isin(*C.RAYAN_FAMILY), value)


def _parsed(responses: DataFrame) -> DataFrame:
    """Entries and date; the date names its text many times, so the text has a step of its own."""
    site_type, body = F.col("site_type"), F.col("body")
    read = captured(responses, ENDPOINT).select(
        *S.KEY,
        "fetched_at",
        entries(site_type, body).alias("entries"),
        date_text(site_type, body).alias("date_text"),
    )
    as_of = jalali.to_date(F.col("date_text"), strict=False).alias("as_of")
    return read.select(*S.KEY, "fetched_at", "entries", as_of)


def allocation(responses: DataFrame) -> DataFrame:
    """``(fund, fetched_at, as_of, item, weight, known)``; a repeated item keeps its last weight.

    Sorting the row's own list by item and position brings repeats together, so the last
    one is found without a shuffle.
    """
    ordered = _parsed(responses).select(
        *S.KEY,
        "fetched_at",
        "as_of",
        F.array_sort(
            F.transform(
                "entries",
                lambda e, i: F.struct(
                    e["item"].alias("item"), i.alias("pos"), e["weight"].alias("weight")
                ),
            )
        ).alias("ordered"),
    )
    following = F.slice("ordered", F.lit(2), F.size("ordered")).alias("following")
    paired = ordered.select(
        *S.KEY, "fetched_at", "as_of", F.arrays_zip("ordered", following).alias("pairs")
    )
    flat = exploded(paired, [*S.KEY, "fetched_at", "as_of"], F.col("pairs"), "p")
    last = flat.filter(~F.col("p.ordered.item").eqNullSafe(F.col("p.following.item")))
    item = F.col("p.ordered.item")
    return last.select(
        *S.KEY,
        "fetched_at",
        "as_of",
        item.alias("item"),
        F.col("p.ordered.weight").alias("weight"),
        known_item(F.col("site_type"), item).alias("known"),
    )


def unknown_items(responses: DataFrame) -> DataFrame:
    """Allocation items that no list of the vendor names."""
    return keep_where(allocation(responses), ~F.col("known")).select(*S.KEY, "item")


def allocation_map(responses: DataFrame) -> DataFrame:
    """Allocation as one map per fund and capture."""
    rows = _parsed(responses)
    items = F.col("entries")["item"]
    keep = F.filter(
        "entries",
        lambda e, i: F.array_position(F.slice(items, i + 2, F.size(items)), e["item"]) == 0,
    )
    return rows.select(*S.KEY, "fetched_at", "as_of", F.map_from_entries(keep).alias("weights"))


def _cash(site_type: Column, items: Column) -> Column:
    """Sum of the cash items; the Rayan vendors must send all three of theirs."""

    def weight(name):
        # The last entry of a repeated item counts.
        return F.get(F.reverse(F.filter(items, lambda e: e["item"] == name)), F.lit(0))["weight"]

    def total(names, missing):
        parts = [F.coalesce(weight(n), F.lit(0.0)) if missing else weight(n) for n in names]
        return parts[0] + parts[1] + parts[2]

    lists = _vendor_lists(C.TADBIR_CASH, C.MABNA_CASH, C.RAYAN_CASH, C.RAYAN2_CASH)
    cash = F.lit(None).cast("double")
    for vendors, names in lists:
        lenient = vendors[0] not in C.RAYAN_FAMILY
        cash = F.when(site_type.isin(*vendors), total(names, lenient)).otherwise(cash)
    return F.when(items.isNotNull(), cash)


def cash_ratio(responses: DataFrame) -> DataFrame:
    """``(fund, fetched_at, cash, error)`` of every response, failed ones included.

    One scan without a shuffle; what goes wrong is named in the row instead of raised, so a
    run over all funds carries on.
    """
    rows = responses.filter(F.col("endpoint") == ENDPOINT)
    failed, site_type = status_error(), F.col("site_type")
    parsed = rows.select(
        *S.KEY,
        "fetched_at",
        failed.alias("failed"),
        F.when(failed.isNull(), entries(site_type, F.col("body"))).alias("entries"),
    )
    scored = parsed.select("*", _cash(site_type, F.col("entries")).alias("cash"))
    error = (
        F.when(F.col("failed").isNotNull(), F.col("failed"))
        .when(F.col("entries").isNull(), F.lit("unreadable body"))
        .when(F.col("cash").isNull(), F.lit("cash item missing"))
    )
    return scored.select(*S.KEY, "fetched_at", "cash", error.alias("error"))


def industries(responses: DataFrame) -> DataFrame:
    """Industry weights: records passed through by one vendor, a sub-list of another's body."""
    body = F.col("body")
    own = exploded(
        captured(responses, "industries", C.RAYAN_FAMILY),
        S.KEY,
        from_json(body, "array<map<string, string>>"),
        "r",
    )
    listed = own.select(*S.KEY, "pos", F.map_values("r").alias("v")).select(
        *S.KEY,
        "pos",
        F.get("v", F.lit(0)).alias("industry"),
        F.get("v", F.lit(1)).try_cast("double").alias("percentage"),
    )
    embedded = exploded(
        captured(responses, ENDPOINT, [C.MABNA]),
        S.KEY,
        from_json(body, S.MABNA_ALLOCATION)["data"]["industries"],
        "r",
    ).select(
        *S.KEY,
        "pos",
        F.col("r.title").alias("industry"),
        F.col("r.percentage").alias("percentage"),
    )
    return listed.unionByName(embedded)


def open_industries(responses: DataFrame) -> DataFrame:
    """Industry payload as the vendor sends it: ``(fund, pos, record)``, no record to declare."""
    return records.open_records(captured(responses, "industries", C.RAYAN_FAMILY), S.KEY, F.col("body"))


def industry_records(responses: DataFrame, record: str) -> DataFrame:
    """Industry payload as a table with the record schema the caller declares."""
    rows = captured(responses, "industries", C.RAYAN_FAMILY)
    return read_records(rows, f"array<struct<{record}>>", S.KEY).drop("pos")


def _truthy(json_text: Column) -> Column:
    return json_text.isNotNull() & ~json_text.isin("false", "0", "null", "")


def state_leverage(pages: DataFrame) -> DataFrame:
    """Leverage facts in the script state of home pages: ``(url, fetched_at, state)``.

    ``is_leverage`` is null when the state cannot be read. The amounts sit under the first
    key of the tenth query's data; should another query hold them, the first one that has
    both is used.
    """
    html = F.col("body")
    flag = F.get_json_object(script_state(html, C.REDUX_STATE), "$.general.data.isLeverage")
    query_schema = "queries array<struct<state: struct<data: string>>>"
    amount = "commonUnitRedemptionValueAmount double, preferredUnitRedemptionValueAmount double"
    parsed = pages.select(
        "url",
        "fetched_at",
        flag.alias("flag"),
        from_json(script_state(html, C.QUERY_STATE), query_schema)["queries"].alias("queries"),
    )
    firsts = F.transform(
        "queries",
        lambda q: from_json(
            F.get(F.map_values(from_json(q["state"]["data"], "map<string, string>")), F.lit(0)),
            amount,
        ),
    )
    read = parsed.select("url", "fetched_at", "flag", firsts.alias("firsts"))

    def usable(a):
        return (
            a["commonUnitRedemptionValueAmount"].isNotNull()
            & a["preferredUnitRedemptionValueAmount"].isNotNull()
        )

    tenth = F.get("firsts", F.lit(9))
    chosen = F.when(usable(tenth), tenth).otherwise(F.get(F.filter("firsts", usable), F.lit(0)))
    state = F.struct(
        F.when(F.col("flag").isNotNull(), _truthy(F.col("flag"))).alias("is_leverage"),
        chosen["commonUnitRedemptionValueAmount"].alias("common"),
        chosen["preferredUnitRedemptionValueAmount"].alias("preferred"),
    )
    return read.select("url", "fetched_at", state.alias("state"))


def leverage(responses: DataFrame) -> DataFrame:
    """``(fund, cash, leverage)`` from the newest captures of every fund.

    Plain funds: ``1 - cash``. Leveraged funds: ``(1 + base / super) * (1 - cash)``, where
    the two amounts come from the live quote or, for one vendor, from the home page. Cash
    and quotes are reduced to numbers per row and meet in one grouping by fund; home pages
    belong to a site, so they are looked up by site afterwards.
    """
    site_type, body = F.col("site_type"), F.col("body")
    is_allocation = F.col("endpoint") == ENDPOINT
    rows = responses.filter(
        F.col("status").between(200, 299)
        & (
            is_allocation
            | ((F.col("endpoint") == "live_navps") & (site_type == C.TADBIR_LEVERAGED))
        )
    )
    quote = from_json(decode_json_string(body), S.LEVERAGED_QUOTE)
    numbers = rows.select(
        *S.KEY,
        "fetched_at",
        F.when(is_allocation, entries(site_type, body)).alias("entries"),
        F.when(
            ~is_allocation,
            F.try_divide(
                text.to_double(quote["BaseUnitsTotalNetAssetValue"], strict=False),
                text.to_double(quote["SuperUnitsTotalNetAssetValue"], strict=False),
            ),
        ).alias("quote_ratio"),
    ).select(
        *S.KEY, "fetched_at", _cash(site_type, F.col("entries")).alias("cash"), "quote_ratio"
    )
    at = F.col("fetched_at")
    per_fund = numbers.groupBy(*S.KEY).agg(
        F.max_by("cash", F.when(F.col("cash").isNotNull(), at)).alias("cash"),
        F.max_by("quote_ratio", F.when(F.col("quote_ratio").isNotNull(), at)).alias("quote_ratio"),
    )
    pages = captured(responses, "home", [C.MABNA])
    per_site = state_leverage(pages).groupBy("url").agg(F.max_by("state", "fetched_at").alias("state"))
    known = lookup_join(per_fund, per_site, ["url"])
    is_leverage = F.col("state.is_leverage")
    ratio = (
        F.when(site_type == C.TADBIR_LEVERAGED, F.col("quote_ratio"))
        .when(
            (site_type == C.MABNA) & is_leverage, F.try_divide("state.common", "state.preferred")
        )
        .when((site_type == C.MABNA) & is_leverage.isNull(), F.lit(None).cast("double"))
        .otherwise(F.lit(0.0))
    )
    return known.select(
        *S.KEY, "cash", ((F.lit(1.0) + ratio) * (F.lit(1.0) - F.col("cash"))).alias("leverage")
    )


def weight_violations(responses: DataFrame, tolerance: float = 1e-6) -> DataFrame:
    """Captures whose weights, of repeated items the last ones, do not add up to one."""
    items = F.col("entries")["item"]
    last = F.filter(
        "entries",
        lambda e, i: ~F.exists(F.slice(items, i + 2, F.size(items)), lambda later: later.eqNullSafe(e["item"])),
    )
    total = F.aggregate(last, F.lit(0.0), lambda acc, e: acc + e["weight"])
    totals = _parsed(responses).select(*S.KEY, "fetched_at", total.alias("total"))
    return keep_where(
        totals, F.col("total").isNull() | (F.abs(F.col("total") - 1) > tolerance)
    )
