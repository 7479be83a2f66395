"""Toxicity by fuzzy lexicon search with context.

Training learns a lexicon from labelled texts: words, and beginnings of words shared by several of them, that are so much
more frequent in toxic texts that chance can't explain it. The lexicon is a trie. Levenshtein automata of all terms run
over it at once, as one automaton whose states are sets of (trie node, edits) and whose transitions are made when first
needed; most words leave it after a few letters. A term takes one edit from five letters on and two from nine on, a
beginning none.

Every hit has a context: quoted (between quotation marks, or in a line that begins with `>`) or not. For each term,
number of edits and context, training measures how much a hit raises the share of toxic texts; the score joins the
independent hits of a text (one minus the product of the misses). A hit kind that training has not seen counts as its
exact, unquoted form, times `UNSEEN` for each difference.

Training takes at most `max_toxic` and `max_clean` labelled rows, those with the smallest hash of the key, each different
text once. Of these texts every word and beginning in three toxic texts or more is tested, and only those beyond chance
reach the driver: the sample alone bounds the lexicon. Quotation marks are looked up once a line, so a very long
text takes time in proportion to its length. Scoring covers all rows and whole texts, without a shuffle. Null and
empty texts have the score of a text without a hit. Without labels of both kinds that score is the share of toxic
labels, or 0. A row with several labels is toxic if one of them says so; null labels and null keys teach nothing.
"""

from __future__ import annotations

import math
import re
from bisect import bisect
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import col, fold, fresh, map_arrow, plus, written

MAX_TOXIC, MAX_CLEAN = 8_000, 24_000
STEMS = (4, 5, 6)
UNSEEN = 0.3
#: The least share of toxic texts among those with a term, and the least share by which a hit kind counts at all.
PURE, COUNTS = 0.9, 0.7
WORD = re.compile(r"[^\W_]+")
PAIRS = {"«": "»", "“": "”", "„": "“", "‹": "›", "‘": "’", "「": "」"}


def words(text: str) -> list[str]:
    return WORD.findall(text.lower())


def allowed_edits(term: str) -> int:
    return 0 if len(term) < 5 else 1 if len(term) < 9 else 2


class Automaton:
    """The union of the Levenshtein automata of all terms, walked over their trie. A term `x*` is a beginning."""

    def __init__(self, terms: list[str]):
        self.terms = terms
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[list[int]] = [[]]
        self.begins: list[list[int]] = [[]]
        self.limit = [0]
        for i, term in enumerate(terms):
            stem, edits, node = term.rstrip("*"), 0 if term.endswith("*") else allowed_edits(term), 0
            self.limit[0] = max(self.limit[0], edits)
            for c in stem:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    for x in (self.children, self.ends, self.begins, self.limit):
                        x.append({} if x is self.children else 0 if x is self.limit else [])
                node = self.children[node][c]
                self.limit[node] = max(self.limit[node], edits)
            (self.begins if term.endswith("*") else self.ends)[node].append(i)
        self._forget()

    def _forget(self) -> None:
        self.ids: dict[tuple, int] = {}
        self.states: list[tuple[dict[int, int], frozenset]] = []
        self.accepted: list[tuple[tuple[int, int], ...]] = []
        self.next: dict[tuple[int, str], int] = {}
        self.start = self._state({0: 0}, frozenset())

    def _state(self, nodes: dict[int, int], hits: frozenset) -> int:
        """The number of a state, closed under letters missing from the word; -1 for the one without a way on."""
        todo = list(nodes)
        while todo:
            node = todo.pop()
            edits = nodes[node] + 1
            for child in self.children[node].values():
                if edits <= self.limit[child] and edits < nodes.get(child, 9):
                    nodes[child] = edits
                    todo.append(child)
        hits = hits | {t for n, e in nodes.items() if e == 0 for t in self.begins[n]}
        if not nodes and not hits:
            return -1
        key = (frozenset(nodes.items()), hits)
        if key not in self.ids:
            best: dict[int, int] = {t: 0 for t in hits}
            for node, edits in nodes.items():
                for t in self.ends[node]:
                    if edits <= allowed_edits(self.terms[t]):
                        best[t] = min(edits, best.get(t, 9))
            self.ids[key] = len(self.states)
            self.states.append((nodes, hits))
            self.accepted.append(tuple(sorted(best.items())))
        return self.ids[key]

    def _step(self, state: int, c: str) -> int:
        nodes, hits = self.states[state]
        new: dict[int, int] = {}
        for node, edits in nodes.items():
            child = self.children[node].get(c)
            if child is not None and edits <= self.limit[child]:
                new[child] = min(edits, new.get(child, 9))
            edits += 1
            if edits <= self.limit[node]:
                new[node] = min(edits, new.get(node, 9))
            for child in self.children[node].values():
                if edits <= self.limit[child]:
                    new[child] = min(edits, new.get(child, 9))
        return self._state(new, hits)

    def match(self, word: str) -> tuple[tuple[int, int], ...]:
        """(term, edits) of every term within its number of edits."""
        if len(self.next) > 2_000_000:
            self._forget()
        state, known = self.start, self.next
        for c in word:
            new = known.get((state, c))
            if new is None:
                new = known[state, c] = self._step(state, c)
            if new < 0:
                return ()
            state = new
        return self.accepted[state]


MARK = re.compile(f'["{"".join(sorted({*PAIRS, *PAIRS.values()}))}]')
CITED = re.compile(r"[^\S\n]*(?:>|&gt;)")


class Line:
    """A line of a text, and where its quotation marks are."""

    def __init__(self, text: str, place: int):
        self.begin = text.rfind("\n", 0, place) + 1
        end = text.find("\n", place)
        self.end = end if end >= 0 else len(text)
        cited = CITED.match(text, self.begin, self.end)
        self.cited = cited.end() if cited else self.end
        self.marks: dict[str, list[int]] = {}
        for m in MARK.finditer(text, self.begin, self.end):
            self.marks.setdefault(m[0], []).append(m.start())

    def quotes(self, place: int) -> bool:
        """Whether a place lies between quotation marks, or the line is a quotation."""
        if place >= self.cited:
            return True
        if not self.marks:
            return False
        straight = self.marks.get('"', ())
        if straight and bisect(straight, place) % 2 and straight[-1] > place:
            return True
        for a, b in PAIRS.items():
            opened, closed = self.marks.get(a, ()), self.marks.get(b, ())
            n = bisect(opened, place)
            if n and closed and closed[-1] > place:
                last = bisect(closed, place)
                if not last or opened[n - 1] > closed[last - 1]:
                    return True
        return False


def quoted(text: str, begin: int, end: int) -> bool:
    """Whether a word of a text is quoted."""
    return Line(text, begin).quotes(begin)


@dataclass
class Lexicon:
    """Terms, the share of a hit kind (term, edits, quoted) that makes a text toxic, and the score without a hit."""

    terms: list[str]
    shares: dict[tuple[int, int, bool], float] = field(default_factory=dict)
    rest: float = 0.0

    def prepare(self) -> Lexicon:
        self.automaton = Automaton(self.terms)
        self.seen: dict[str, tuple] = {}
        return self

    def hits(self, text: str | None) -> set[tuple[int, int, bool]]:
        """The kinds of hits in a text."""
        if not text or not self.terms:
            return set()
        lower = text.lower()
        if len(self.seen) > 500_000:
            self.seen = {}
        found, seen, match = {}, self.seen, self.automaton.match
        for w in set(WORD.findall(lower)):
            m = seen.get(w)
            if m is None:
                m = seen[w] = match(w)
            if m:
                found[w] = m
        out = set()
        if found:
            line = None
            for at in WORD.finditer(lower):
                if at[0] in found:
                    if line is None or at.start() >= line.end:
                        line = Line(lower, at.start())
                    q = line.quotes(at.start())
                    out.update((t, e, q) for t, e in found[at[0]])
        return out

    def share(self, kind: tuple[int, int, bool]) -> float:
        term, edits, q = kind
        known = self.shares.get(kind)
        if known is None:
            known = self.shares.get((term, 0, False), 0.0) * UNSEEN ** (q + (edits > 0) * 0.5)
        return known

    def score(self, text: str | None) -> float:
        best: dict[int, float] = {}
        for kind in self.hits(text):
            best[kind[0]] = max(best.get(kind[0], 0.0), self.share(kind))
        miss = 1 - self.rest
        for p in best.values():
            miss *= 1 - p
        return 1 - miss


def _counts(keys):
    """Sums, batch by batch, in how many toxic and clean texts each key occurs. Columns: text, toxic."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = keys()
        for batch in batches:
            sums: dict[bool, Counter] = {True: Counter(), False: Counter()}
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                sums[bool(toxic)].update(of(text))
            names = list(sums[True].keys() | sums[False].keys())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(names, pa.string()), pa.array([sums[True][n] for n in names], pa.int64()),
                    pa.array([sums[False][n] for n in names], pa.int64()),
                ],
                ["key", "toxic", "clean"],
            )

    return count


COUNTED = "key string, toxic long, clean long"


def counted(rows: DataFrame, keys) -> DataFrame:
    """key, toxic, clean: texts of either label in which a key of `keys()(text)` occurs."""
    sums = map_arrow(rows.select("text", "toxic"), _counts(keys), COUNTED)
    return sums.groupBy("key").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


QUOTED = re.compile("^[ \\t]*(?:>|&gt;)[^\n]*|" + "|".join(f"{a}[^{a}{b}\\n]*{b}" for a, b in [('"', '"'), *PAIRS.items()]), re.M)


def unquoted(text: str) -> str:
    return QUOTED.sub(" ", text)


def candidates_of(text: str | None) -> set[str]:
    """The words outside of quotations, and their beginnings."""
    own = {w for w in words(unquoted(text or "")) if len(w) >= 3 and not w.isdigit()}
    return own | {w[:k] + "*" for w in own for k in STEMS if len(w) > k}


def evidence(t: float, c: float, n1: float, n0: float) -> float:
    """Log likelihood that a key's texts are toxic at their own rate over the common rate; 0 if that is lower."""
    common, own = n1 / (n1 + n0), t / max(t + c, 1)
    if own <= common:
        return 0.0
    return t * math.log(own / common) + (c * math.log((1 - own) / (1 - common)) if c else 0.0)


def beyond_chance(counts: DataFrame, n1: int, n0: int, least: float) -> DataFrame:
    """The keys that `choose_terms` can take, by the same bounds; the last digits of a logarithm are left to it."""
    t, c, common = F.col("toxic").cast("double"), F.col("clean").cast("double"), n1 / (n1 + n0)
    own = t / (t + c)
    likely = t * F.ln(own / common) + F.when(c > 0, c * F.ln((1 - own) / (1 - common))).otherwise(0.0)
    return counts.where((own > common) & (own >= PURE) & (likely >= least - 1e-6))


def least_evidence(tested: int) -> float:
    return math.log(max(tested, 1)) + 3


def choose_terms(rows: list[tuple[str, int, int]], n1: int, n0: int, tested: int) -> list[str]:
    """Terms beyond chance among `tested` keys. A beginning stands for its words if no single one makes it up."""
    least = least_evidence(tested)
    good = {k: t for k, t, c in rows if evidence(t, c, n1, n0) >= least and t / (t + c) >= PURE}
    whole = {k: t for k, t in good.items() if not k.endswith("*")}
    most: Counter = Counter()
    for w, t in whole.items():
        for k in STEMS:
            most[w[:k] + "*"] = max(most[w[:k] + "*"], t)
    stems: list[str] = []
    cover: set[str] = set()
    for k in sorted((k for k in good if k.endswith("*")), key=len):
        if most[k] <= 0.6 * good[k] and not any(k[:n] in cover for n in STEMS):
            stems.append(k)
            cover.add(k[:-1])
    kept = [w for w in whole if not any(w[:k] in cover for k in STEMS)] + stems
    return sorted(kept)


def sample_labelled(
    docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, max_toxic: int = MAX_TOXIC, max_clean: int = MAX_CLEAN
) -> tuple[DataFrame, float]:
    """text, toxic of the labelled rows that teach; and the share of toxic labels among all labels."""
    marks = labels.select(col(key).alias("key"), col(label).cast("int").alias("toxic")).where("key is not null and toxic is not null")
    marks = marks.groupBy("key").agg((F.max("toxic") > 0).alias("toxic"))
    share = marks.agg(F.avg(F.col("toxic").cast("double"))).first()[0] or 0.0
    mixed = marks.withColumn("mix", F.xxhash64("key"))
    take = [mixed.where(w).orderBy("mix", "key").limit(n).drop("mix") for w, n in (("toxic", max_toxic), ("not toxic", max_clean))]
    ids = written(take[0].unionByName(take[1]), "toxicity-ids")  # max_toxic + max_clean rows at most
    rows = docs.select(col(key).alias("key"), col(text).cast("string").alias("text")).join(F.broadcast(ids), "key")
    rows = rows.select(F.coalesce("text", F.lit("")).alias("text"), "toxic")
    return written(rows.groupBy("text").agg(F.max("toxic").alias("toxic")), "toxicity-sample"), share


def train(
    docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, max_toxic: int = MAX_TOXIC, max_clean: int = MAX_CLEAN
) -> Lexicon:
    sample, share = sample_labelled(docs, labels, key, text, label, max_toxic, max_clean)
    sizes = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    n1, n0 = sizes.get(True, 0), sizes.get(False, 0)
    if not n1 or not n0:
        return Lexicon([], {}, share)
    tested = written(counted(sample, lambda: candidates_of).where("toxic >= 3"), "toxicity-candidates")
    n = tested.count()
    found = [tuple(r) for r in beyond_chance(tested, n1, n0, least_evidence(n)).select("key", "toxic", "clean").collect()]
    lexicon = Lexicon(choose_terms(found, n1, n0, n))
    shared = sample.sparkSession.sparkContext.broadcast(lexicon)

    def kinds():
        known = shared.value.prepare()
        return lambda t: {f"{a} {b} {int(q)}" for a, b, q in known.hits(t)} or {"none"}

    for name, t, c in counted(sample, kinds).collect():
        # the share of toxic texts among those with the hit, at the common share, less that share
        rate1, rate0 = (t + share) / (n1 + 1), (c + (1 - share)) / (n0 + 1)
        p = share * rate1 / (share * rate1 + (1 - share) * rate0)
        if name == "none":
            lexicon.rest = p
        else:
            a, b, q = name.split()
            lift = (p - share) / (1 - share)
            lexicon.shares[int(a), int(b), q == "1"] = lift if lift >= COUNTS else 0.0
    return lexicon


def score(df: DataFrame, text: str, lexicon: Lexicon, score_name: str = "score") -> DataFrame:
    """All columns and the score, with underscores in front if its name is taken."""
    schema = plus(df.schema, (fresh(score_name, df.columns), "double"))
    at = df.columns.index(text)
    shared = df.sparkSession.sparkContext.broadcast(lexicon)  # bounded by the sample it was learned from

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value.prepare()
        for batch in batches:
            scores = [known.score(t) for t in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], schema.names)

    return map_arrow(df, rate, schema)


def toxicity_report(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str) -> DataFrame:
    """doc_id, held_out, score, predicted; labels of held-out rows (fold 0 of 5) are not read."""
    lexicon = train(docs, labels.where(fold(key, 5) != 0), key, text, label)
    rows = docs.select(col(key).alias("doc_id"), col(text).cast("string").alias("_text"))
    rated = score(rows, "_text", lexicon)
    return rated.select(
        "doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
