"""Toxicity of whole texts by a weighted finite-state grammar over sentences.

The insult transducer maps words to symbols and weights; others name threats, targets, negations and words of report.
Three transducers over these symbols then decide for each hit, by the states that they are in, whether its sentence
has a target, whether a negation reaches it, and whether it is reported speech. They are composed into one machine. A text
is scored by the matched sentences, never by a word alone.

The insult lexicon (words and word beginnings, in any language) and the weights of the composed machine's final labels
are learned from labelled texts.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pixelloom.llm.common import materialise

# Closed-class words of the grammar.
TARGETS = frozenset("you your yours yourself u they them he she him her people du dich dir ihr euch sie tu toi te vous il elle tú ti usted vosotros ellos".split())
NEGATIONS = frozenset("not no never isn't aren't wasn't don't doesn't ain't nobody nicht kein keine keinen nie pas jamais aucun ne nunca ningún ninguna".split())
REPORTS = frozenset("said says say claimed claims wrote writes quoted reported told called alleged sagte behauptete schrieb berichtete disait affirmé écrit rapporté dijo afirmó escribió informó".split())
THREATS = frozenset("kill hurt destroy beat shoot stab burn töten umbringen schlagen tuer frapper détruire matar golpear destruir".split())

TOKEN = re.compile(r"\w+(?:'\w+)?|[.!?;:,\n]")
PREFIXES = (3, 4, 5, 6, 7, 8)
#: Words after a negation, and before one, that it reaches; a comma or colon ends the reach.
REACH, REACH_BACK = 6, 3
#: Symbols: insult, threat, target, negation, report, comma, colon, any other word.
SYMBOLS = "ITYNRCOx"
#: Symbols of hits that the target transducer passes on: insult without and with a target, threat with one.
HITS = ("I", "I+", "T+")


@dataclass(frozen=True)
class Transducer:
    """arcs: (state, symbol) to its (next state, output) choices. A path counts if it ends in one of finals."""

    start: object
    arcs: dict
    finals: frozenset

    def outputs(self, symbols: list[str]) -> list[str] | None:
        """The outputs along a path that accepts the symbols, or None. The machines of this module have one such path at most."""
        alive, back = {self.start}, []
        for s in symbols:
            came: dict = {}
            for q in alive:
                for after, out in self.arcs.get((q, s), ()):
                    came.setdefault(after, (q, out))
            back.append(came)
            alive = came.keys()
        ends = [q for q in alive if q in self.finals]
        if not ends:
            return None
        q, out = ends[0], []
        for came in reversed(back):
            q, o = came[q]
            out.append(o)
        return out[::-1]


def reachable(start, symbols, step, final) -> Transducer:
    """The transducer of the states that step(state, symbol) -> [(next state, output)] reaches from start."""
    arcs, todo, seen = {}, [start], {start}
    while todo:
        q = todo.pop()
        for s in symbols:
            if found := tuple(step(q, s)):
                arcs[q, s] = found
                new = {after for after, _ in found} - seen
                seen |= new
                todo += new
    return Transducer(start, arcs, frozenset(q for q in seen if final(q)))


def compose(a: Transducer, b: Transducer) -> Transducer:
    """First a, then b on its outputs."""

    def step(q, s):
        return [((qa, qb), out) for qa, mid in a.arcs.get((q[0], s), ()) for qb, out in b.arcs.get((q[1], mid), ())]

    symbols = {s for _, s in a.arcs}
    return reachable((a.start, b.start), sorted(symbols), step, lambda q: q[0] in a.finals and q[1] in b.finals)


def anywhere(sign: str, hits: dict[str, tuple[str, str]], symbols) -> Transducer:
    """Changes each hit by whether ``sign`` is anywhere in the sentence: hits has its outputs with and without.

    States: none yet, seen, promised (a hit has been changed, so the sign must come), denied (so it must not).
    """

    def step(q, s):
        if s == sign:
            return [] if q == "denied" else [("seen", s)]
        if s not in hits:
            return [(q, s)]
        yes, no = hits[s]
        return {"none": [("promised", yes), ("denied", no)], "seen": [("seen", yes)], "promised": [("promised", yes)], "denied": [("denied", no)]}[q]

    return reachable("none", symbols, step, lambda q: q != "promised")


def within(sign: str, after: int, before: int, stops: str, hits, symbols) -> Transducer:
    """Adds - to each hit at most ``after`` words behind the sign or ``before`` words ahead of it, with no stop between.

    States (f, d, p): the sign reaches f more words; it must not come in the next d; it must come in the next p.
    """

    def step(q, s):
        f, d, p = q
        if s == sign:
            return [] if d else [((after, 0, 0), s)]
        if s in stops:
            return [] if p else [((0, 0, 0), s)]
        if p == 1:
            return []
        on = (max(f - 1, 0), max(d - 1, 0), max(p - 1, 0))
        if s not in hits:
            return [(on, s)]
        if f or p:
            return [(on, f"{s}-")]
        return [((0, on[1], before), f"{s}-"), ((0, before, 0), s)]

    return reachable((0, 0, 0), symbols, step, lambda q: not q[2])


@lru_cache(maxsize=1)
def grammar_machine() -> Transducer:
    """Targets, then negation, then reported speech, which overrides negation."""
    targets = anywhere("Y", {"I": ("I+", "I"), "T": ("T+", "x")}, SYMBOLS)
    symbols = [*(s for s in SYMBOLS if s not in "IT"), *HITS]
    negation = within("N", REACH, REACH_BACK, "CO", HITS, symbols)
    marked = [*HITS, *(f"{h}-" for h in HITS)]
    report = anywhere("R", {h: (f"{h.rstrip('-')}~", h) for h in marked}, [*symbols, *marked[len(HITS) :]])
    return compose(compose(targets, negation), report)


#: What the composed machine says of a hit; the last feature is the number of matched sentences.
LABELS = [h + mood for h in HITS for mood in ("", "-", "~")]


def tokens(text: str) -> list[str]:
    return TOKEN.findall(text.lower())


def terms(words: set[str]) -> set[str]:
    """Words, and beginnings of longer words as ``begin*``: the candidates of the lexicon."""
    out = {w for w in words if w[0].isalpha()}
    for n in PREFIXES:
        out |= {w[:n] + "*" for w in words if len(w) > n and w[0].isalpha()}
    return out


@dataclass
class Grammar:
    """lexicon: term to weight (log-odds). arcs: weight of each of LABELS, and of the log of matched sentences. bias: of the score."""

    lexicon: dict[str, float]
    arcs: list[float] = field(default_factory=lambda: [0.5, 0.1, 0.1, 1.0, 0.2, 0.2, 2.0, 0.3, 0.3, 0.3])
    bias: float = -2.0

    def weight(self, word: str) -> float:
        """Output of the insult transducer for a word: the heaviest entry that accepts it."""
        lex = self.lexicon
        best = lex.get(word, 0.0)
        for n in PREFIXES:
            if len(word) > n:
                best = max(best, lex.get(word[:n] + "*", 0.0))
        return best

    def features(self, text: str | None) -> list[float]:
        """For each of LABELS the heaviest hit with it (a threat weighs 1), and the log of one more than the matched sentences."""
        found = [0.0] * (len(LABELS) + 1)
        words = tokens(text) if text else []
        hits = {w: x for w in set(words) if (x := self.weight(w)) > 0}
        if not hits and THREATS.isdisjoint(words):
            return found
        machine, n, sentence, any_hit = grammar_machine(), 0, [], False
        for w in [*words, "."]:
            if w in ".!?;\n":
                if any_hit:
                    outputs = machine.outputs([symbol(x, hits) for x in sentence])
                    labelled = [(x, out) for x, out in zip(sentence, outputs, strict=True) if out in PLACES]
                    n += bool(labelled)
                    for x, out in labelled:
                        found[PLACES[out]] = max(found[PLACES[out]], hits.get(x, 1.0))
                sentence, any_hit = [], False
            else:
                sentence.append(w)
                any_hit = any_hit or w in hits or w in THREATS
        found[-1] = math.log1p(n)
        return found

    def score(self, text: str | None) -> float:
        z = self.bias + sum(a * x for a, x in zip(self.arcs, self.features(text), strict=True))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


PLACES = {label: i for i, label in enumerate(LABELS)}


def symbol(word: str, hits: dict[str, float]) -> str:
    if word in hits:
        return "I"
    for s, known in (("T", THREATS), ("Y", TARGETS), ("N", NEGATIONS), ("R", REPORTS)):
        if word in known:
            return s
    return {",": "C", ":": "O"}.get(word, "x")


def sample_labelled(docs: DataFrame, labels: DataFrame, max_rows: int, label: str = "toxic") -> DataFrame:
    """(text, label) of labelled rows, thinned by a hash of doc_id to about max_rows. Rows with nulls take no part."""
    good = labels.where(f"doc_id IS NOT NULL AND {label} IN (0, 1)").groupBy("doc_id").agg(F.max(label).alias("label"))
    n = good.count()
    if n > max_rows:
        good = good.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(1_000_000 * max_rows / n))
    return docs.select("doc_id", "text").where("text IS NOT NULL").join(F.broadcast(good), "doc_id").select("text", "label")


def chosen_lexicon(counts: DataFrame, bad: int, good: int, min_support: int, min_odds: float) -> dict[str, float]:
    """Terms (term, bad, good) with their log-odds that stand out among toxic texts; word beginnings come before the words that they cover."""
    odds = F.log((F.col("bad") + 0.5) / (bad + 1)) - F.log((F.col("good") + 0.5) / (good + 1))
    both, share = F.col("bad") + F.col("good"), bad / (bad + good)
    ratio = 2 * (F.col("bad") * F.log(F.col("bad") / (both * share)) + F.col("good") * F.log(F.greatest("good", F.lit(1e-9)) / (both * (1 - share))))
    clear = 2 * math.log(max(2, counts.where("bad + good > 0").count())) + 4
    kept = counts.where(F.col("bad") >= min_support).withColumn("odds", odds).where((F.col("odds") >= min_odds) & (ratio >= clear))
    lexicon: dict[str, float] = {}
    for r in sorted(kept.select("term", "odds").collect(), key=lambda r: (not r.term.endswith("*"), len(r.term), r.term)):  # bounded like the sample they come from
        body = r.term.rstrip("*")
        covered = [lexicon[p] for m in PREFIXES if m <= len(body) and (p := body[:m] + "*") in lexicon and p != r.term]
        if not covered or r.odds > max(covered) + 1:
            lexicon[r.term] = float(r.odds)
    return lexicon


def learn(rows: DataFrame, min_support: int = 4, min_odds: float = 2.5) -> Grammar:
    """Grammar fitted to (text, label) rows, a bounded sample.

    Terms are counted by document and label in parallel. A term enters the lexicon if it is in at least min_support toxic
    texts, its log-odds are min_odds or more, and its log-likelihood ratio stands out among as many terms as there are.
    The arcs are fitted by logistic regression on what the machine says of each text with the lexicon of the other half
    of the sample, so they don't see words that were chosen on their own text; the lexicon that is returned comes from
    the whole sample. Without toxic rows the lexicon is empty.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = [Counter() for _ in range(4)]  # by half and label

        def flush() -> pa.RecordBatch:
            keys = sorted(set().union(*seen))
            out = pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), *(pa.array([c[k] for k in keys], pa.int64()) for c in seen)], names=["term", "g0", "b0", "g1", "b1"])
            for c in seen:
                c.clear()
            return out

        for b in batches:
            for text, label, half in zip(b.column(0), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                seen[2 * half + label].update(terms(set(tokens(text.as_py()))))
                if sum(map(len, seen)) > 300_000:
                    yield flush()
        yield flush()

    half = F.pmod(F.xxhash64("text"), F.lit(2)).cast("int")
    rows = materialise(rows.select("text", "label", half.alias("half")), "labelled")
    n = {(r.half, r.label): r.n for r in rows.groupBy("half", "label").agg(F.count("*").alias("n")).collect()}
    size = lambda label, *halves: sum(n.get((h, label), 0) for h in halves)
    if not size(1, 0, 1) or not size(0, 0, 1):
        return Grammar({})
    sums = [F.sum(c).alias(c) for c in ("g0", "b0", "g1", "b1")]
    counts = materialise(rows.mapInArrow(count, "term string, g0 long, b0 long, g1 long, b1 long").groupBy("term").agg(*sums), "terms")
    of_half = lambda h: counts.select("term", F.col(f"b{h}").alias("bad"), F.col(f"g{h}").alias("good"))
    every = counts.select("term", (F.col("b0") + F.col("b1")).alias("bad"), (F.col("g0") + F.col("g1")).alias("good"))
    fewer = max(2, min_support // 2)
    other = [Grammar(chosen_lexicon(of_half(1 - h), size(1, 1 - h), size(0, 1 - h), fewer, min_odds)) for h in (0, 1)]
    grammar = Grammar(chosen_lexicon(every, size(1, 0, 1), size(0, 0, 1), min_support, min_odds))

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [other[h].features(t.as_py()) for t, h in zip(b.column(0), b.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(1).cast(pa.int32()), pa.array(x, pa.list_(pa.float64()))], names=["label", "x"])

    found = rows.mapInArrow(measured, "label int, x array<double>").groupBy("label", "x").agg(F.count("*").alias("n")).collect()  # bounded like the sample
    grammar.arcs, grammar.bias = logistic(np.array([r.x for r in found]), np.array([r.label for r in found]), np.array([r.n for r in found]))
    return grammar


def logistic(x: np.ndarray, y: np.ndarray, n: np.ndarray, ridge: float = 1.0) -> tuple[list[float], float]:
    """Weighted logistic regression with a ridge, by Newton steps; arcs below zero are held at zero."""
    x = np.c_[x, np.ones(len(x))]
    w = np.zeros(x.shape[1])
    free = np.ones(len(w), bool)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        keep = np.diag(np.r_[np.full(len(w) - 1, ridge), 1e-6])
        grad = x.T @ (n * (p - y)) + keep @ w
        hess = (x * (n * p * (1 - p))[:, None]).T @ x + keep
        step = np.zeros_like(w)
        step[free] = np.linalg.solve(hess[np.ix_(free, free)] + 1e-9 * np.eye(free.sum()), grad[free])
        w -= np.clip(step, -2, 2)
        low = (w < 0) & (np.arange(len(w)) < len(w) - 1)
        w[low], free[low] = 0.0, False
    return [float(v) for v in w[:-1]], float(w[-1])


def score_texts(docs: DataFrame, grammar: Grammar, threshold: float = 0.7, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, predicted) for every row: score in 0 to 1 of the whole text, predicted 1 from threshold on.

    Null and empty texts get the score of a text without matches. Repeated rows repeat their result; other columns are
    ignored. One pass, no shuffle; the grammar, bounded by the sample it was learned from, goes along with the function.
    """
    schema = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("score", T.DoubleType())])
    sent = docs.sparkSession.sparkContext.broadcast(grammar)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = sent.value
        for b in batches:
            scores = [g.score(t.as_py()) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    scored = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
