"""Links of web pages and the best among them."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.errors import AmbiguousLinkError, LinkNotFoundError

#: Any href that contains these is taken for a file of that kind.
CSV, ZIP = r"(?i)\.csv", r"(?i)\.zip"
#: Words in a link and what they add to its score.
WORDS = {"sponsor": 2, "licensed": 1, "register": 1, "worker": 1}
_DATED = r"(?i)BasicCompanyDataAsOneFile-(20\d{2}-\d{2}-\d{2})\.zip"


class _Anchors(HTMLParser):
    def __init__(self) -> None:
        super().__init__()
        self.found: list[tuple[str, str]] = []
        self.href, self.text = "", []

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "a" and (href := next((v for k, v in attrs if k == "href" and v), "")):
            self.href, self.text = href, []

    def handle_data(self, data: str) -> None:
        if self.href:
            self.text.append(data)

    def handle_endtag(self, tag: str) -> None:
        if tag == "a" and self.href:
            self.found.append((self.href, " ".join("".join(self.text).split())))
            self.href = ""


def anchors(html: str | None) -> list[tuple[str, str]]:
    """(href, text) of a page's anchors that have an href and end."""
    parser = _Anchors()
    parser.feed(html or "")
    return parser.found


def extract_links(pages: DataFrame, key: str, url: str, html: str) -> DataFrame:
    """(key, url, nth, href, text), hrefs made absolute. The HTML parser is the one thing here that
    built-in functions can't do."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(k, u, i, urljoin(u or "", h.strip()), t) for k, u, x in zip(*(c.to_pylist() for c in batch.columns)) for i, (h, t) in enumerate(anchors(x)) if h.strip()]
            columns = list(zip(*rows)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string()))], ["key", "url", "nth", "href", "text"])

    return pages.select(F.col(key).cast("long"), url, html).mapInArrow(run, "key long, url string, nth long, href string, text string")


def score(href: Column, text: Column, words: dict[str, int] = WORDS) -> Column:
    whole = F.lower(F.concat_ws(" ", href, text))
    out = F.lit(0)
    for w, n in words.items():
        out = out + F.when(F.contains(whole, F.lit(w)), n).otherwise(0)
    return out


def best_links(links: DataFrame, pattern: str = CSV, words: dict[str, int] = WORDS) -> DataFrame:
    """Per page the links with the highest score among those that fit, and how many share it."""
    scored = links.filter(F.col("href").rlike(pattern)).withColumn("score", score(F.col("href"), F.col("text"), words))
    top = scored.groupBy("key").agg(F.max("score").alias("score"))
    tied = scored.join(top, ["key", "score"])
    return tied.groupBy("key", "score").agg(F.count(F.lit(1)).alias("n_tied"), F.min("href").alias("href"))


def the_best_link(links: DataFrame, pattern: str = CSV) -> str:
    """The one best link of a page; none or several are errors."""
    found = best_links(links, pattern).orderBy(F.desc("score")).limit(2).collect()
    if not found:
        raise LinkNotFoundError(pattern)
    if found[0]["n_tied"] > 1:
        raise AmbiguousLinkError(found[0]["href"])
    return found[0]["href"]


def the_archive_link(links: DataFrame) -> str:
    """The newest dated archive, else the only one named like it."""
    zips = links.filter(F.col("href").rlike(ZIP)).select("href", F.regexp_extract("href", _DATED, 1).alias("day"))
    dated = zips.filter("day <> ''").orderBy(F.desc("day"), F.desc("href")).limit(2).collect()
    if dated:
        if len(dated) > 1 and dated[0]["day"] == dated[1]["day"]:
            raise AmbiguousLinkError(str([r["href"] for r in dated]))
        return dated[0]["href"]
    named = zips.filter(F.contains(F.lower("href"), F.lit("basiccompanydataasonefile"))).limit(2).collect()
    if len(named) != 1:
        raise (AmbiguousLinkError if named else LinkNotFoundError)(str([r["href"] for r in named]))
    return named[0]["href"]


def archive_links(links: DataFrame) -> DataFrame:
    """The same for each page (`key`) of many: href, and status found, ambiguous or missing. Links are counted by page
    and day before pages meet, so a page of many links is no hot group."""
    fits = F.col("href").rlike(ZIP)
    named = fits & F.contains(F.lower("href"), F.lit("basiccompanydataasonefile"))
    by_day = links.withColumn("day", F.when(fits, F.regexp_extract("href", _DATED, 1))).groupBy("key", "day").agg(
        F.count(F.lit(1)).alias("n"), F.max("href").alias("href"), F.count_if(named).alias("n_named"), F.max(F.when(named, F.col("href"))).alias("named")
    )
    page = by_day.groupBy("key").agg(F.max(F.when(F.col("day") != "", F.struct("day", "n", "href"))).alias("dated"), F.sum("n_named").alias("n_named"), F.max("named").alias("named"))
    n = F.when(F.col("dated").isNotNull(), F.col("dated.n")).otherwise(F.col("n_named"))
    href = F.when(F.col("dated").isNotNull(), F.col("dated.href")).otherwise(F.col("named"))
    return page.select("key", F.when(n == 1, href).alias("href"), F.when(n == 1, "found").when(n > 1, "ambiguous").otherwise("missing").alias("status"))
