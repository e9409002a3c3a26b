"""URL filter: rules first, then host word segmentation and multinomial naive Bayes.

Names without separators are cut by a unigram Viterbi search: of all ways to cut, the words with the largest product of
probabilities. A word outside the table has a probability that falls tenfold with each letter. The table holds the count of every word
of a text column and the words of the labelled examples. It stays a distributed table: the names of the urls are cut into all
their substrings, and those are joined with it. Naive Bayes with add-one smoothing scores the host's words and the path's;
words that no example has say nothing, so only names that contain an example's word are segmented.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass, replace
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardmill.llm.shared import stored

VOCABULARY = 50_000
LONGEST = 24
PRIOR_BLOCK = 0.2

#: Labelled examples, as the words of hosts and paths. Words that any host may hold (www, example, language codes) are in none.
BLOCK_EXAMPLES = (
    "cheap pills", "cheap pills online pharmacy", "discount pharmacy viagra cialis", "buy pills no prescription", "spam farm", "link farm spam", "free bets",
    "free bets casino bonus", "online casino slots jackpot", "poker gambling odds betting", "sports betting bets", "porn xxx adult sex", "live sex cams girls",
    "hot escort dating adult", "payday loans fast cash", "earn money fast easy", "replica watches cheap", "lottery winner prize claim", "warez crack keygen serial",
    "torrent pirate free movies", "malware phishing verify account", "hack cheats free coins", "miracle diet pills", "crypto doubler profit",
)
ALLOW_EXAMPLES = (
    "news article", "daily news", "science history research", "university library archive", "city council",
    "school education course", "museum art culture", "health hospital advice", "travel guide map", "recipe food kitchen", "weather report", "open source code docs",
    "book review", "music concert", "garden home", "sport club", "photo gallery", "forum help", "about contact", "wiki page",
)
_LETTERS = re.compile(r"[^\W\d_]+")


def host_and_path(url: str | None) -> tuple[str, str]:
    """Both empty for a null url or one without ``://``."""
    at = (url or "").find("://")
    if at < 0:
        return "", ""
    rest = url[at + 3:]
    ends = [i for i in map(rest.find, "/?#") if i >= 0]
    cut = min(ends, default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    return host, re.split(r"[?#]", rest[cut:], maxsplit=1)[0]


class Rules:
    """Rules ``host/path`` for hosts with their subdomains and paths that start alike; the longest that fits wins, block before allow at equal rules."""

    def __init__(self, rules: Iterable[tuple[str, str]]):
        self.of_host: dict[str, list[tuple[str, str, str]]] = {}
        for rule, verdict in rules:
            host, slash, path = rule.partition("/")
            self.of_host.setdefault(host, []).append((rule, slash + path, verdict))

    def find(self, host: str, path: str) -> tuple[str | None, str | None]:
        best: tuple = (-1, False, None, None)
        parts = host.split(".")
        for i in range(len(parts)):
            for rule, start, verdict in self.of_host.get(".".join(parts[i:]), ()):
                if path.startswith(start):
                    best = max(best, (len(rule), verdict == "block", rule, verdict), key=lambda x: x[:2])
        return best[2], best[3]


@dataclass
class UrlModel:
    log_word: dict[str, float]
    log_unknown: float
    ratio: dict[str, float]
    prior: float
    total: int = 1

    def segment(self, name: str) -> tuple[str, ...]:
        """The most probable words of a run of letters."""
        best: list[tuple[float, int]] = [(0.0, 0)]
        for end in range(1, len(name) + 1):
            options = []
            for start in range(max(0, end - LONGEST), end):
                word = name[start:end]
                score = self.log_word.get(word)
                options.append((best[start][0] + (score if score is not None else self.log_unknown - len(word) * math.log(10)), start))
            best.append(max(options))
        out, end = [], len(name)
        while end:
            start = best[end][1]
            out.append(name[start:end])
            end = start
        return tuple(reversed(out))

    def words(self, text: str) -> list[str]:
        return [w for name in _LETTERS.findall(text.lower()) for w in self.segment(name)]

    def log_odds(self, words: Iterable[str]) -> float:
        """Of block to allow."""
        return self.prior + sum(self.ratio.get(w, 0.0) for w in words)


def fit(counts: dict[str, int], block: Iterable[str] = BLOCK_EXAMPLES, allow: Iterable[str] = ALLOW_EXAMPLES, prior_block: float = PRIOR_BLOCK,
        others: int = 0) -> UrlModel:
    """``counts``: of the word table. Example words that it lacks enter with the count of a frequent word.
    ``others``: occurrences of words of two letters and more that are not in ``counts``."""
    bad, fine = Counter(w for x in block for w in x.split()), Counter(w for x in allow for w in x.split())
    known = {*bad, *fine}
    table = Counter({w: n for w, n in counts.items() if len(w) > 1})
    usual = max(1, (sum(table.values()) + others) // 2000)
    for w in known:
        table[w] = max(table[w], usual)
    total = sum(table.values()) + others
    ratio = {w: math.log((bad[w] + 1) / (bad.total() + len(known))) - math.log((fine[w] + 1) / (fine.total() + len(known))) for w in known}
    return UrlModel({w: math.log(n / total) for w, n in table.items()}, math.log(10 / total), ratio, math.log(prior_block / (1 - prior_block)), total)


def count_table(rows: DataFrame, text: str | Column) -> DataFrame:
    """``word``, ``n``: runs of letters of a text column, lower case."""
    column = F.col(text) if isinstance(text, str) else text
    words = rows.select(F.explode(F.split(F.lower(column), r"[^\p{L}]+")).alias("word")).where("word <> ''")
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def word_counts(rows: DataFrame, text: str | Column, most: int = VOCABULARY) -> dict[str, int]:
    """For small texts: words that are at least one in ``most`` of all, at the driver."""
    counts = count_table(rows, text)
    frequent = counts.where(F.col("n") * most >= counts.agg(F.sum("n")).scalar())
    return {r["word"]: r["n"] for r in frequent.collect()}


def fit_table(counts: DataFrame, block: Iterable[str] = BLOCK_EXAMPLES, allow: Iterable[str] = ALLOW_EXAMPLES, prior_block: float = PRIOR_BLOCK) -> UrlModel:
    """The model with the example words alone; one row for each of them and one for all others come to the driver."""
    block, allow = list(block), list(allow)
    known = sorted({w for x in (*block, *allow) for w in x.split()})
    sums = counts.where(F.length("word") > 1).groupBy(F.when(F.col("word").isin(known), F.col("word")).alias("word")).agg(F.sum("n").alias("n"))
    found = {r["word"]: r["n"] for r in sums.collect()}
    return fit({w: n for w, n in found.items() if w is not None}, block, allow, prior_block, found.get(None, 0))


def _arrow(batch: pa.RecordBatch, names: Iterable[str], columns: Iterable[pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, *names])


def name_scores(names: DataFrame, counts: DataFrame, model: UrlModel) -> DataFrame:
    """``name``, ``score``: what each of the distinct ``name`` adds to the log odds, cut with the counts of all its substrings.
    Names have two letters or more. ``model``: of ``fit_table``."""
    size = F.length("name")
    parts = F.flatten(F.transform(F.sequence(F.lit(1), size - 1), lambda at: F.transform(
        F.sequence(F.lit(2), F.least(F.lit(LONGEST), size - at + 1)), lambda k: F.col("name").substr(at, k))))
    pieces = names.select("name", F.explode(F.array_distinct(parts)).alias("word"))
    found = pieces.join(counts, "word", "left").groupBy("name").agg(F.collect_list(F.when(F.col("n").isNotNull(), F.struct("word", "n"))).alias("counts"))
    shared = names.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        bayes = shared.value
        for batch in batches:
            scores = []
            for name, own in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                table = {x["word"]: math.log(x["n"] / bayes.total) for x in own}
                whole = replace(bayes, log_word=table | bayes.log_word)
                scores.append(sum(bayes.ratio.get(w, 0.0) for w in whole.segment(name)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["name", "score"])

    return found.mapInArrow(run, "name string, score double")


def judged_by_table(rows: DataFrame, rules: Iterable[tuple[str, str]], counts: DataFrame, *, url: str = "url") -> DataFrame:
    """All columns and ``host``, ``path``, ``rule``, ``verdict``, with the counts of ``count_table``, however many. Older ones of these
    names are replaced. A url without words is allowed unless a rule blocks it."""
    new = ("host", "path", "rule", "verdict")
    rows = rows.drop(*new)
    counts = stored(counts, "url-words")
    model = fit_table(counts)
    shared = rows.sparkSession.sparkContext.broadcast((Rules(rules), [w for w, x in model.ratio.items() if x]))
    names = "__names"

    def run(batches):
        found, telling = shared.value
        tells = re.compile("|".join(map(re.escape, telling)) or r"(?!)").search
        for batch in batches:
            out: list[list] = [[] for _ in (*new, names)]
            for x in batch.column(batch.schema.get_field_index(url)).to_pylist():
                host, path = host_and_path(x)
                rule, verdict = found.find(host, path)
                own = () if verdict else [n for n in _LETTERS.findall(f"{host}/{path}".lower()) if tells(n)]
                for column, value in zip(out, (host, path, rule, verdict, " ".join(own) or None), strict=True):
                    column.append(value)
            yield _arrow(batch, (*new, names), [pa.array(x, pa.string()) for x in out])

    def split(part: DataFrame) -> DataFrame:
        return part.mapInArrow(run, T.StructType([*part.schema.fields, *(T.StructField(n, T.StringType()) for n in (*new, names))]))

    lists = split(rows.select(url)).where(F.col(names).isNotNull()).select(names).distinct()
    placed = lists.select(names, F.posexplode(F.split(names, " ")).alias("at", "name"))
    scores = name_scores(placed.select("name").distinct(), counts, model)
    ordered = F.array_sort(F.collect_list(F.struct("at", "score")))
    sums = placed.join(scores, "name").groupBy(names).agg(F.aggregate(ordered, F.lit(model.prior), lambda total, x: total + x["score"]).alias("__score"))
    whole = split(rows)
    usual = F.lit("block" if model.prior > 0 else "allow")
    plain = whole.where(F.col(names).isNull()).withColumn("verdict", F.coalesce("verdict", usual)).drop(names)
    told = whole.where(F.col(names).isNotNull()).join(sums, names).withColumn("verdict", F.when(F.col("__score") > 0, "block").otherwise("allow"))
    return plain.unionByName(told.drop(names, "__score"))


def judged(rows: DataFrame, rules: Iterable[tuple[str, str]], model: UrlModel, *, url: str = "url") -> DataFrame:
    """With a model in memory: all columns and ``host``, ``path``, ``rule``, ``verdict``, ``score`` (log odds of block), ``words``. Older ones of
    these names are replaced.

    A url without words is allowed unless a rule blocks it.
    """
    new = ("host", "path", "rule", "verdict", "score", "words")
    rows = rows.drop(*new)
    own = Rules(rules)
    shared = rows.sparkSession.sparkContext.broadcast((own, model))
    schema = T.StructType([*rows.schema.fields, *(T.StructField(n, T.StringType()) for n in new[:4]), T.StructField("score", T.DoubleType()),
                           T.StructField("words", T.ArrayType(T.StringType()))])

    def run(batches):
        found, bayes = shared.value
        of_name = lru_cache(maxsize=20_000)(bayes.words)
        for batch in batches:
            out: list[list] = [[] for _ in new]
            for x in batch.column(batch.schema.get_field_index(url)).to_pylist():
                host, path = host_and_path(x)
                rule, verdict = found.find(host, path)
                words = [*of_name(host), *(w for part in path.split("/") if part for w in of_name(part))]
                score = bayes.log_odds(words)
                for column, value in zip(out, (host, path, rule, verdict or ("block" if score > 0 else "allow"), score, words), strict=True):
                    column.append(value)
            kinds = [pa.string()] * 4 + [pa.float64(), pa.list_(pa.string())]
            yield _arrow(batch, new, map(pa.array, out, kinds))

    return rows.mapInArrow(run, schema)
