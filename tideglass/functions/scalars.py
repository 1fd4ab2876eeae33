"""Scalar functions of the market, filing and transcript pipelines, as JVM expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def md5_partition(text: Column, parts: int) -> Column:
    """The md5 of text, as a number of 128 bits, modulo parts: folded over four words of 32 bits."""
    digest, rest = F.md5(text), F.lit(0).cast("bigint")
    for i in range(4):
        word = F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("bigint")
        rest = F.pmod(rest * F.lit(1 << 32) + word, F.lit(parts).cast("bigint"))
    return rest.cast("int")


def pad_cik(cik: Column) -> Column:
    """Digits only, ten of them with leading zeros; null stays null."""
    return F.lpad(F.regexp_replace(cik.cast("string"), r"\D", ""), 10, "0")


def concept_label(name: Column) -> Column:
    """The local name in words: `us-gaap:NetIncomeLoss` is `Net Income Loss`."""
    return F.initcap(F.trim(F.regexp_replace(F.element_at(F.split(name, ":", 2), -1), "([A-Z])", " $1")))


def unit_type(measures: Column) -> Column:
    """monetary, shares or other, by the first measure that tells."""
    money = lambda m: F.lower(m).contains("currency") | F.upper(m).rlike("USD|EUR|GBP")
    share = lambda m: F.lower(m).contains("shares")
    telling = F.get(F.filter(measures, lambda m: money(m) | share(m)), F.lit(0))
    return F.when(telling.isNull(), "other").when(money(telling), "monetary").otherwise("shares")


def clip(text: Column, n: int) -> Column:
    """At most n characters; longer texts end in three dots."""
    return F.when(F.length(text) > n, F.concat(F.substring(text, 1, n - 3), F.lit("..."))).otherwise(text)


def human_number(x: Column) -> Column:
    """$1.23B, $1.23M, $1.23K or $1.23."""
    size = F.abs(x)
    form = lambda by, mark: F.format_string(f"$%.2f{mark}", x / F.lit(float(by)))
    return F.when(size >= 1e9, form(1e9, "B")).when(size >= 1e6, form(1e6, "M")).when(size >= 1e3, form(1e3, "K")).otherwise(form(1, ""))


def plain_date(text: Column) -> Column:
    """MM/dd/yyyy or yyyy-MM-dd as yyyy-MM-dd; anything else stays as it is."""
    us = F.regexp_replace(text, r"^(\d{2})/(\d{2})/(\d{4})$", "$3-$1-$2")
    good = us.rlike(r"^\d{4}-\d{2}-\d{2}$") & F.try_to_date(us, "yyyy-MM-dd").isNotNull()
    return F.when(good, us).otherwise(text)


def whole_number(text: Column) -> Column:
    """A number in text as a whole number (12.0 is 12); null if it is none."""
    return text.try_cast("double").try_cast("bigint")


def topic_of(category: Column, prefix: str = "news-") -> Column:
    """The topic of a news category; unknown and null categories go to stocks."""
    low = F.lower(F.coalesce(category, F.lit("")))
    name = F.when(low.contains("stock") | (low == "general"), "stocks").when(low.contains("crypto"), "crypto").when(low.contains("commodit"), "commodities").when(low.contains("forex"), "forex").otherwise("stocks")
    return F.concat(F.lit(prefix), name)


def price_change(price: Column, before: Column) -> tuple[Column, Column]:
    """Change and change in percent, rounded to 2; 0 without a price before or where that is 0."""
    usable = before.isNotNull() & (before != 0)
    return F.round(F.when(usable, price - before).otherwise(0.0), 2), F.round(F.when(usable, (price - before) / before * 100).otherwise(0.0), 2)


def token_estimate(text: Column) -> Column:
    return F.call_function("div", F.length(text), F.lit(4).cast("bigint"))
