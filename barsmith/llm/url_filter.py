"""URL filters (operator 1): blocked Bloom filter, then an exact hash join.

Listed entries are strings: a rule ``host + path`` fits its host, all
subdomains and every path that starts with its path; a listed canonical URL
(:func:`canonical`, stored with a leading ``?``, which no host or path holds) fits pages of that form.
Every page gives the strings under which it could be listed: its host's
suffixes at label borders times its path's prefixes of the lengths that occur
in the list, and its own canonical URL.  Those strings are tested against a
blocked Bloom filter - one 512-bit block a string, one bit in each of the
block's eight words - and only possible hits go on to the exact join with the
list, which removes the false positives.

The filter has a fixed number of blocks, so what is broadcast never exceeds
``blocks`` * 72 bytes; a longer list only lets more false positives through to
the exact join, which is an ordinary equi-join (sort-merge with AQE's skew
splitting, or a hash join when its size is small).

Order of fit: the longest entry string, then the longer host; `block` wins if
one string is listed with both verdicts.  No entry: `block` if the canonical
URL is listed, else `allow`.

Defined results: a null url or one without ``://`` has an empty host and path
and is allowed; repeated pages stay repeated; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barsmith.llm import bloom
from barsmith.llm.common import ascii_lower, session, with_copies


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lower."""
    at = F.instr(url, "://")
    rest = F.substring(url, at + 3, F.length(url))
    return F.when(at > 0, ascii_lower(F.regexp_extract(rest, r"\A[^/?#]*", 0))).otherwise(F.lit(""))


def path_of(url: Column) -> Column:
    at = F.instr(url, "://")
    rest = F.substring(url, at + 3, F.length(url))
    return F.when(at > 0, F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)).otherwise(F.lit(""))


def canonical(host: Column, path: Column) -> Column:
    """Scheme, query and fragment are gone already; drops a final ``.htm(l)``,
    ``index`` page name and trailing slashes."""
    return F.concat(host, F.regexp_replace(path, r"(/index)?(\.html?)?/*\z", ""))


def _candidates(host: Column, path: Column, labels: int, lengths: list[int]) -> Column:
    """All strings under which a rule of the list could fit (host, path)."""
    parts = F.split(host, r"\.")
    n = F.size(parts)
    suffixes = F.transform(F.sequence(F.lit(1), F.least(n, F.lit(labels))),
                           lambda k: F.array_join(F.slice(parts, n - k + 1, k), "."))
    prefixes = F.transform(F.filter(F.array(*[F.lit(x) for x in lengths]), lambda x: x <= F.length(path)),
                           lambda x: F.substring(path, F.lit(1), x))
    return F.flatten(F.transform(suffixes, lambda h: F.transform(prefixes, lambda p: F.concat(h, p))))


def judge(pages: DataFrame, rules: list[tuple[str, str]], listed: DataFrame | None = None, *, id_col: str = "page_id",
          url_col: str = "url", blocks: int = bloom.BLOCKS) -> DataFrame:
    """page_id, host, path, rule, verdict, canonical.

    ``rules``: (verdict, "host/path") with the path from the first slash on;
    a configuration list of any length that fits the driver.  ``listed``:
    a table with a column ``canonical`` of blocked URLs, of any size."""
    spark = session(pages.sparkSession)
    entries = spark.createDataFrame([("block" if v == "block" else "allow", r) for v, r in rules],
                                    "verdict string, entry string")
    entries = entries.groupBy("entry").agg(F.max("verdict").alias("verdict"))  # block > allow
    hosts = [r.partition("/")[0] for _, r in rules]
    labels = max([h.count(".") + 1 for h in hosts], default=1)
    lengths = sorted({len(r) - len(h) for (_, r), h in zip(rules, hosts, strict=True)}) or [0]
    if listed is not None:
        urls = listed.select(F.concat(F.lit("?"), F.col("canonical")).alias("entry")).filter(F.col("entry").isNotNull())
        entries = entries.unionByName(urls.distinct().withColumn("verdict", F.lit("block")))

    url = F.col(url_col)
    base = pages.select(F.col(id_col).alias("page_id"), F.coalesce(host_of(url), F.lit("")).alias("host"),
                        F.coalesce(path_of(url), F.lit("")).alias("path"))
    base = base.groupBy("page_id", "host", "path").agg(F.count("*").alias("_n"))
    own = F.array(F.concat(F.lit("?"), canonical(F.col("host"), F.col("path"))))
    keys = _candidates(F.col("host"), F.col("path"), labels, lengths)
    tried = base.select("page_id", "host", "path", F.explode(F.concat(keys, own)).alias("entry"))
    hits = bloom.possible_hits(tried, "entry", bloom.build(entries, "entry", blocks), blocks).join(entries, "entry")

    # the best entry a page; pages without a hit come from `base`
    rank = F.struct(F.when(F.col("entry").startswith("?"), F.lit(0)).otherwise(F.length("entry")).alias("len"),
                    F.instr("entry", "/").alias("host_len"), F.col("verdict"), F.col("entry"))
    none = F.lit(None).cast("struct<len:int,host_len:int,verdict:string,entry:string>")
    both = (base.select("page_id", "host", "path", "_n", none.alias("_hit"))
            .unionByName(hits.select("page_id", "host", "path", F.lit(0).cast("long").alias("_n"), rank.alias("_hit"))))
    best = both.groupBy("page_id", "host", "path").agg(F.sum("_n").alias("_n"), F.max("_hit").alias("_hit"))
    return with_copies(best, "_n").select(
        "page_id", "host", "path",
        F.when(F.col("_hit.len") > 0, F.col("_hit.entry")).alias("rule"),
        F.coalesce(F.col("_hit.verdict"), F.lit("allow")).alias("verdict"),
        canonical(F.col("host"), F.col("path")).alias("canonical"))
