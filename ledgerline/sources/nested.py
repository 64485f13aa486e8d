"""Parsers for nested JSON / XML / page text held in a string column (S-15..S-29).

Each takes a DataFrame with a text column (``spark.read.text(..., wholetext=True)``
of landed files, or a rendered column) and flattens it with ``from_json`` /
``from_xml`` / ``parse_json`` + ``explode``/``inline``. Dynamic keys are
``MapType``; heterogeneous items are ``VARIANT``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def flatten_envelope(df: DataFrame, doc: str, schema: str, path: str, keep: Sequence[str] = ()) -> DataFrame:
    """S-15: JSON envelope -> one row per item of the array at ``path`` (dotted),
    item fields as columns (``json_normalize``)."""
    parsed = df.select(*keep, F.from_json(_c(doc), schema).alias("_d"))
    return parsed.select(*keep, F.inline_outer(F.col("_d." + path)))


def nested_map_rows(df: DataFrame, doc: str, top: str = "values", names=("indicator", "country", "year"),
                    keep: Sequence[str] = ()) -> DataFrame:
    """S-16: ``{top: {indicator: {country: {year: value}}}}`` with dynamic keys ->
    (indicator, country, year, value) rows (three map explodes)."""
    schema = f"struct<{top}: map<string, map<string, map<string, double>>>>"
    p = df.select(*keep, F.from_json(_c(doc), schema).alias("_d"))
    a = p.select(*keep, F.explode(F.col(f"_d.{top}")).alias(names[0], "_m1"))
    b = a.select(*keep, names[0], F.explode("_m1").alias(names[1], "_m2"))
    return b.select(*keep, names[0], names[1], F.explode("_m2").alias(names[2], "value"))


SDMX_SCHEMA = ("struct<structure: struct<dimensions: struct<observation: array<struct<id: string, "
               "values: array<struct<id: string>>>>>>, observations: map<string, array<double>>>")


def sdmx_observations(df: DataFrame, doc: str, keep: Sequence[str] = (), n_dims: int | None = None) -> DataFrame:
    """S-17: SDMX-JSON: an observation key ``i:j:...`` indexes the value list of
    each dimension. Returns one row per observation with ``dimensions`` (map of
    dimension id -> value id, any number of dimensions) and ``value``; with
    ``n_dims`` also positional columns ``dim_0 .. dim_{n-1}``."""
    p = df.select(*keep, F.from_json(_c(doc), SDMX_SCHEMA).alias("_d"))
    obs = p.select(*keep, F.col("_d.structure.dimensions.observation").alias("_dims"),
                   F.explode(F.col("_d.observations")).alias("_k", "_v"))
    idx = F.split(F.col("_k"), ":")
    # value id of dimension i = dims[i].values[idx[i]] (0-based indices in the key)
    vals = F.transform(idx, lambda x, i: F.try_element_at(
        F.try_element_at(F.col("_dims"), (i + 1).cast("int"))["values"], x.try_cast("int") + 1)["id"])
    ids = F.transform(F.col("_dims"), lambda d: d["id"])
    out = obs.select(*keep, vals.alias("_vals"), ids.alias("_ids"),
                     F.try_element_at(F.col("_v"), F.lit(1)).alias("value"))
    out = out.withColumn("dimensions", F.map_from_arrays(F.slice("_ids", 1, F.size("_vals")), "_vals"))
    cols = [F.try_element_at("_vals", F.lit(i + 1)).alias(f"dim_{i}") for i in range(n_dims or 0)]
    return out.select(*keep, "dimensions", *cols, "value")


def columns_to_rows(df: DataFrame, doc: str, fields: dict[str, str], keep: Sequence[str] = ()) -> DataFrame:
    """S-18 / S-26: column-oriented JSON (parallel arrays) -> rows via
    ``arrays_zip`` + ``inline``. ``fields`` maps array name -> element type."""
    schema = "struct<" + ", ".join(f"`{k}`: array<{t}>" for k, t in fields.items()) + ">"
    p = df.select(*keep, F.from_json(_c(doc), schema).alias("_d"))
    return p.select(*keep, F.inline(F.arrays_zip(*[F.col(f"_d.`{k}`").alias(k) for k in fields])))


def heterogeneous_items(df: DataFrame, doc: str, keep: Sequence[str] = ()) -> DataFrame:
    """S-19: array items that are either ``[key, value]`` or ``{date, totalFees}``
    -> (key, value), via VARIANT (no schema guess)."""
    v = df.select(*keep, F.try_parse_json(_c(doc)).alias("_v"))
    out = v.select(*keep, F.explode(F.try_variant_get(F.col("_v"), "$", "array<variant>")).alias("_item"))
    key = F.coalesce(F.try_variant_get("_item", "$[0]", "long"), F.try_variant_get("_item", "$.date", "long"))
    val = F.coalesce(F.try_variant_get("_item", "$[1]", "double"), F.try_variant_get("_item", "$.totalFees", "double"))
    return out.select(*keep, key.alias("key"), val.alias("value"))


def positional_arrays(df: DataFrame, doc: str, names: Sequence[str], types: Sequence[str],
                      keep: Sequence[str] = ()) -> DataFrame:
    """S-20: ``[[open_time, open, high, ...], ...]`` string arrays -> typed columns."""
    p = df.select(*keep, F.explode(F.from_json(_c(doc), "array<array<string>>")).alias("_r"))
    return p.select(*keep, *[F.try_element_at("_r", F.lit(i + 1)).try_cast(t).alias(n)
                             for i, (n, t) in enumerate(zip(names, types))])


def explode_path(df: DataFrame, doc: str, schema: str, array_path: str, select: dict[str, str],
                 keep: Sequence[str] = ()) -> DataFrame:
    """S-21 / S-24: explode the array at ``array_path`` and select dotted fields
    (``select`` maps output name -> path inside the item, or ``doc.`` paths)."""
    p = df.select(*keep, F.from_json(_c(doc), schema).alias("_d"))
    e = p.select(*keep, "_d", F.explode(F.col("_d." + array_path)).alias("_i"))
    return e.select(*keep, *[F.col(path if path.startswith("_d.") else "_i." + path).alias(n)
                             for n, path in select.items()])


def pick_by_role(arr, role_field: str, role: str, fallback_index: int) -> Column:
    """S-22: first element whose ``role_field`` equals ``role``, else the element
    at ``fallback_index`` (1-based)."""
    a = _c(arr)
    return F.coalesce(F.try_element_at(F.filter(a, lambda c: c[role_field] == role), F.lit(1)),
                      F.try_element_at(a, F.lit(fallback_index)))


def double_explode(df: DataFrame, doc: str, schema: str, outer: str, inner: str, keep: Sequence[str] = ()) -> DataFrame:
    """S-23: ``outer[].inner[]`` -> one row per inner item, outer fields kept as ``_o``."""
    p = df.select(*keep, F.from_json(_c(doc), schema).alias("_d"))
    o = p.select(*keep, F.explode(F.col("_d." + outer)).alias("_o"))
    return o.select(*keep, "_o", F.explode(F.col("_o." + inner)).alias("_g"))


# The ten reported concepts and their metric names, and the forms that count
GAAP_METRICS = {
    "Revenues": "revenue",
    "RevenueFromContractWithCustomerExcludingAssessedTax": "revenue_v2",
    "NetIncomeLoss": "net_income",
    "EarningsPerShareBasic": "eps_basic",
    "EarningsPerShareDiluted": "eps_diluted",
    "GrossProfit": "gross_profit",
    "OperatingIncomeLoss": "operating_income",
    "CashAndCashEquivalentsAtCarryingValue": "cash",
    "LongTermDebt": "long_term_debt",
    "CommonStockSharesOutstanding": "shares_outstanding",
}
REPORT_FORMS = ("10-K", "10-Q", "20-F")


def xbrl_facts(df: DataFrame, doc: str, concepts: dict[str, str] = GAAP_METRICS, forms: Sequence[str] = REPORT_FORMS,
               keep: Sequence[str] = (), taxonomy: str = "us-gaap") -> DataFrame:
    """S-25: company facts ``facts.<taxonomy>.<concept>.units.<unit>[]`` -> (date,
    metric, value, form, period, unit) rows for the wanted concepts and forms of
    one taxonomy. Rows without a readable date are left out; a value that is no
    number is NULL. Concept and unit are dynamic keys (maps)."""
    schema = ("struct<facts: map<string, map<string, struct<units: map<string, "
              "array<struct<end: string, val: string, form: string, fp: string>>>>>>>")
    p = df.select(*keep, F.from_json(_c(doc), schema).alias("_d"))
    c = p.select(*keep, F.explode(F.try_element_at("_d.facts", F.lit(taxonomy))).alias("concept", "_u"))
    cmap = F.create_map(*[x for k, v in concepts.items() for x in (F.lit(k), F.lit(v))])
    c = c.filter(F.col("concept").isin(*concepts.keys()))
    u = c.select(*keep, F.element_at(cmap, F.col("concept")).alias("metric"), F.explode("_u.units").alias("unit", "_e"))
    e = u.select(*keep, "metric", "unit", F.inline("_e")).filter(F.col("form").isin(*forms))
    return e.select(*keep, F.col("end").try_cast("timestamp").alias("date"), "metric",
                    F.col("val").try_cast("double").alias("value"), "form", F.col("fp").alias("period"), "unit") \
        .filter("date IS NOT NULL")


FORM4_XML_SCHEMA = ("issuer STRUCT<issuerTradingSymbol: STRING, issuerName: STRING>, "
                    "reportingOwner ARRAY<STRUCT<reportingOwnerId: STRUCT<rptOwnerName: STRING>>>, "
                    "nonDerivativeTable STRUCT<nonDerivativeTransaction: ARRAY<STRUCT<"
                    "transactionDate: STRUCT<value: STRING>, "
                    "transactionAmounts: STRUCT<transactionShares: STRUCT<value: STRING>, "
                    "transactionPricePerShare: STRUCT<value: STRING>, "
                    "transactionAcquiredDisposedCode: STRUCT<value: STRING>>>>>")


def extract_xml(text) -> Column:
    """S-28: the XML document inside a text wrapper: from ``<?xml`` to the end of
    its root, else the ``<ownershipDocument>...</ownershipDocument>`` span."""
    t, end = _c(text), "</ownershipDocument>"

    def span(start):
        a = F.instr(t, start)
        b = F.when(a > 0, F.position(F.lit(end), t, a))
        return F.when(b > 0, F.substring(t, a, b + len(end) - a))
    return F.coalesce(span(F.lit("<?xml")), span(F.lit("<ownershipDocument>")))


def form4_transactions(df: DataFrame, xml: str, file_date: str | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """S-27: ownership XML -> one row per non-derivative transaction; value =
    shares x price (NULL for a bad number); the first owner is named; a missing
    or blank transaction date falls back to the file date."""
    x = df.select(*keep, *( [file_date] if file_date else []),
                  F.from_xml(F.regexp_replace(_c(xml), r"^<\?xml[^>]*\?>", ""), FORM4_XML_SCHEMA).alias("_x"))
    t = x.select(*keep, *([file_date] if file_date else []), F.col("_x.issuer.issuerTradingSymbol").alias("ticker"),
                 F.col("_x.issuer.issuerName").alias("issuer_name"),
                 F.try_element_at(F.col("_x.reportingOwner"), F.lit(1))["reportingOwnerId"]["rptOwnerName"].alias("owner_name"),
                 F.explode(F.col("_x.nonDerivativeTable.nonDerivativeTransaction")).alias("_t"))
    shares = F.trim("_t.transactionAmounts.transactionShares.value").try_cast("double")
    price = F.trim("_t.transactionAmounts.transactionPricePerShare.value").try_cast("double")
    tdate = F.nullif(F.trim("_t.transactionDate.value"), F.lit(""))
    if file_date:
        tdate = F.coalesce(tdate, F.col(file_date))
    return t.select(*keep, "ticker", "issuer_name", "owner_name", tdate.alias("transaction_date"),
                    shares.alias("shares"), price.alias("price_per_share"),
                    F.col("_t.transactionAmounts.transactionAcquiredDisposedCode.value").alias("acquired_disposed"),
                    (shares * price).alias("transaction_value"))


def page_metrics(df: DataFrame, text: str, patterns: dict[str, str], keep: Sequence[str] = ()) -> DataFrame:
    """S-29: one metric row per pattern: the first capture, thousands separators
    removed, as double (NULL when absent)."""
    vals = [F.regexp_replace(F.regexp_extract(_c(text), p, 1), ",", "").try_cast("double") for p in patterns.values()]
    stacked = F.array(*[F.struct(F.lit(k).alias("metric"), v.alias("value")) for k, v in zip(patterns, vals)])
    return df.select(*keep, F.inline(stacked))
