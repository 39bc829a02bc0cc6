"""URL filter: rules by host and path, and a cascade of Bloom filters over the corpus's own hosts.

The cascade holds the listed hosts exactly. Level 0 encodes the listed keys; level 1 the unlisted keys of
the corpus that level 0 lets through; level 2 the listed keys that level 1 lets through; and so on until
nothing passes wrongly. The key universe is every host of the table, so for any of its rows the first level
that denies a key decides: no false answer and no join of the rows. Filters are built by grouped
aggregation (bit positions folded with bit_or) and reach the rows as one array value per level.

Level 0 takes 9 bits per listed key, level 1 as many per unlisted key that passes level 0 (a 64th of them), later
levels a 64th of the level two before. `MAX_KEYS` bounds level 0; a longer list is answered by an equi-join on the
key instead, with the same results. Level 1 grows with the number of distinct unlisted hosts and has no bound of its own.

Defined results
---------------
* The host starts after the first `://` and ends before `/`, `?` or `#`; A-Z are lower-cased. The path goes
  on up to `?` or `#`. A null url, or one without `://`, has an empty host and path.
* A rule fits its host and all subdomains of it when the path starts with the rule's path. The longest
  fitting rule wins; of two as long, the blocking one.
* No rule: a listed host is blocked, any other, the empty one too, is allowed (unless it is listed).
* Null host keys never occur, nulls in other columns do not matter, repeated rows are judged alike, an
  empty table gives an empty result. Columns named as results are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanwork.session import staged

# Bits per key and hash functions of each level: one key in about 64 passes wrongly.
BITS_PER_KEY = 9
HASHES = 6
MAX_KEYS = 32_000_000
MAX_LEVELS = 40

# (verdict, host, path) of the rules this table is judged by.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
# Words that make a host a listed one in the query below.
SPAM_WORDS = ("casino", "pills", "bets", "ads")


def split_url(pages: DataFrame, url: str = "url") -> DataFrame:
    """`pages` with `host` and `path` added."""
    rest = F.expr("case when locate('://', `#url`) > 0 then substring(`#url`, locate('://', `#url`) + 3) else '' end")
    raw = F.regexp_extract(F.col("#rest"), "^[^/?#]*", 0)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return (
        pages.withColumn("#url", F.coalesce(F.col(f"`{url}`"), F.lit("")))
        .withColumn("#rest", rest)
        .withColumn("host", F.translate(raw, upper, lower))
        .withColumn("path", F.regexp_extract(F.expr("substring(`#rest`, length(regexp_extract(`#rest`, '^[^/?#]*', 0)) + 1)"), "^[^?#]*", 0))
        .drop("#url", "#rest")
    )


def match_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """Struct (rule, verdict) of the longest fitting rule, or null. `rules` is a short list."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    shown = sorted(rules, key=lambda r: (len(r[1] + r[2]), r[0] == "block"))
    for verdict, domain, prefix in shown:  # the last `when` added is asked first
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(prefix)
        found = F.when(fits, F.struct(F.lit(domain + prefix).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


class Level:
    """One filter: `n_bits` bits in an array of longs, held in the shared folder."""

    def __init__(self, keys: DataFrame, n_keys: int, number: int):
        self.number = number
        self.n_words = max(1, -(-n_keys * BITS_PER_KEY // 64))
        places = F.explode(F.array(*[self._place(F.col("key"), i) for i in range(HASHES)]))
        bit = F.expr("shiftleft(1L, cast(pmod(place, 64) as int))")
        folded = (
            keys.select(places.alias("place"))
            .groupBy(F.shiftright("place", 6).alias("id")).agg(F.bit_or(bit).alias("bits"))
        )
        whole = keys.sparkSession.range(self.n_words).join(folded, "id", "left")
        parts = F.array_sort(F.collect_list(F.struct("id", F.coalesce("bits", F.lit(0).cast("long")).alias("bits"))))
        self.table = staged(whole.agg(F.transform(parts, lambda p: p["bits"]).alias("bits")), "bloom")

    def _place(self, key: Column, i: int) -> Column:
        """The i-th bit of a key, by double hashing with level-specific salts."""
        one, two = (F.pmod(F.xxhash64(F.lit(2 * self.number + j), key), F.lit(2**40 + 15)) for j in (0, 1))
        return F.pmod(one + F.lit(i) * two, F.lit(64 * self.n_words).cast("long"))

    def holds(self, key: Column) -> Column:
        bits = self.table.select("bits").scalar()
        test = F.lit(True)
        for i in range(HASHES):
            place = self._place(key, i)
            word = F.get(bits, F.shiftright(place, 6).cast("int"))
            test = test & (F.getbit(word, F.pmod(place, F.lit(64)).cast("int")) == 1)
        return test


def build_cascade(universe: DataFrame) -> list[Level]:
    """Filters that tell, for every key of `universe` (key, listed), whether it is listed.

    `universe` has one row per key. Each level works on the keys that the level before lets through
    wrongly, a 64th of them on average, so a handful of levels ends it.
    """
    levels: list[Level] = []
    encoded, other = universe.where("listed"), universe.where("not listed")
    while (n_keys := encoded.count()) or not levels:
        if len(levels) == MAX_LEVELS:
            raise RuntimeError("the cascade does not end: keys repeat in the universe")
        level = Level(encoded, n_keys, len(levels))
        levels.append(level)
        encoded, other = staged(other.where(level.holds(F.col("key"))), "passed"), encoded
    return levels


def listed_by(levels: list[Level], key: Column) -> Column:
    """Whether the cascade says that a key of its universe is listed: the first denying level decides."""
    answer = F.lit(len(levels) % 2 == 1)
    for level in reversed(levels):
        answer = F.when(~level.holds(key), F.lit(level.number % 2 == 1)).otherwise(answer)
    return answer


def filter_urls(pages: DataFrame, listed: Column, rules: Sequence[tuple[str, str, str]] = RULES, url: str = "url",
                max_keys: int = MAX_KEYS) -> DataFrame:
    """`pages` with host, path, rule and verdict added.

    `listed` says of a `host` whether it is on the list, and is asked once per distinct host.
    """
    split = split_url(pages, url)
    hosts = split.select("host").distinct().withColumn("listed", F.coalesce(listed, F.lit(False)))
    universe = staged(hosts.select(F.col("host").alias("key"), "listed"), "hosts")
    if universe.where("listed").count() <= max_keys:
        judged = split.withColumn("#listed", listed_by(build_cascade(universe), F.col("host")))
    else:
        known = universe.where("listed").select(F.col("key").alias("host"), F.lit(True).alias("#listed"))
        judged = split.join(known, "host", "left").withColumn("#listed", F.coalesce("#listed", F.lit(False)))
    fallback = F.when(F.col("#listed"), "block").otherwise("allow")
    return (
        judged.withColumn("#match", match_rule(F.col("host"), F.col("path"), rules))
        .withColumn("rule", F.col("#match.rule"))
        .withColumn("verdict", F.coalesce(F.col("#match.verdict"), fallback))
        .drop("#match", "#listed")
    )


def is_spam_host(host: Column) -> Column:
    """A label of the host holds one of the words, whole or between hyphens."""
    return host.rlike(rf"(^|[.-])({'|'.join(SPAM_WORDS)})([.-]|$)")
