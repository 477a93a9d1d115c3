"""Toxicity by a fuzzy lexicon: Levenshtein automata intersected with a trie.

Fit, on at most ``MAX_FIT_ROWS`` labelled rows that are not held out:

* lexicon: words and word beginnings (written ``stem*``) that occur in toxic
  documents far more than in others, at most ``MAX_TERMS``;
* automaton: the lexicon is a trie; the states of its terms' Levenshtein
  automata, (trie node, edits), are determinized together into one table over
  bytes, so that a word is matched against all terms in one walk;
* weights: for each term, number of edits and context, the smoothed share of
  toxic documents among the sample's documents with such a match.

Context: the window of ``WINDOW`` words on each side of a match decides between
``quoted`` (the match stands between quotation marks, or a word of reporting
stands near) and ``plain``.

* mixture: a logistic regression of the pooled weights of a document's matches,
  the strongest of them, and their number.

Scoring walks every word of every whole text (vectorized over words).

Defined cases: null and empty texts score as texts without a match;
null ids are scored (their hash is that of an empty text); repeated rows are
scored alike; with no labelled rows, or labels of one class only, every score is
0; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txlake.llm.common import doc_chunks, held_out, held_out_py, joined, written

MAX_FIT_ROWS = 12_000
MAX_TERMS = 64
MAX_PATTERNS = 3000
#: Least log-likelihood gain of a lexicon entry: some 100,000 patterns compete,
#: so chance alone reaches about their logarithm.
MIN_EVIDENCE = 12.0
#: Characters of the word beginnings that may become stems.
STEM_SIZES = range(4, 9)
WINDOW = 6
FOLDS = 5
#: Prior share of toxic documents for a match by (edits, quoted), and its weight
#: in documents.
PRIOR = {(0, False): 0.8, (1, False): 0.7, (2, False): 0.65, (0, True): 0.25, (1, True): 0.2, (2, True): 0.2}
PRIOR_ROWS = 2.0

#: Word characters of this operator (fixed): letters, digits, non-ASCII bytes,
#: and signs that stand in for letters.
WORDS = re.compile(rb"[a-z0-9*@$\x80-\xff]+")
_IS_WORD = np.zeros(256, dtype=bool)
_IS_WORD[[*range(48, 58), *range(97, 123), *range(128, 256), 36, 42, 64]] = True
#: Marks and words of quotation (fixed).
MARKS = re.compile("[\"“”„«»]")
REPORTING = {
    "said", "says", "saying", "wrote", "writes", "quote", "quoted", "quotes", "quoting", "called", "calling",
    "reported", "reports", "alleged", "cited", "citing", "stated", "slur", "insult", "term", "word",
}


def edits_allowed(term: str) -> int:
    n = len(term.encode()) - term.endswith("*")
    if term.endswith("*"):
        return 1 if n >= 7 else 0
    return 2 if n >= 9 else 1 if n >= 4 else 0


class Automaton:
    """Determinized product of the lexicon trie with its Levenshtein automata.

    ``step[state, symbol[byte]]`` is the next state, 0 being dead; ``term`` and
    ``edits`` tell what a word accepts that ends in the state (term -1: none).
    A stem accepts as soon as it is read and stays accepted."""

    def __init__(self, terms: list[str]):
        nodes: list[dict] = [{}]
        ends: list[list[int]] = [[]]
        reach = [0]  # most edits allowed by a term below the node
        for t, term in enumerate(terms):
            node, k = 0, edits_allowed(term)
            reach[0] = max(reach[0], k)
            for b in term.removesuffix("*").encode():
                if b not in nodes[node]:
                    nodes[node][b] = len(nodes)
                    nodes.append({})
                    ends.append([])
                    reach.append(0)
                node = nodes[node][b]
                reach[node] = max(reach[node], k)
            ends[node].append(t)
        symbols = sorted({b for n in nodes for b in n})
        self.symbol = np.zeros(256, dtype=np.int16)  # 0: a byte of no term
        for i, b in enumerate(symbols, 1):
            self.symbol[b] = i
        allowed = [edits_allowed(t) for t in terms]
        stem = [t.endswith("*") for t in terms]

        def closed(pairs):
            """With deletions followed, and without states that others dominate."""
            best: dict[int, int] = {}
            todo = list(pairs)
            while todo:
                node, e = todo.pop()
                if e > reach[node] or best.get(node, 99) <= e:
                    continue
                best[node] = e
                todo += [(child, e + 1) for child in nodes[node].values()]
            return frozenset(best.items())

        def accepted(state, stems_only):
            found = [
                (e, t) for node, e in state for t in ends[node] if e <= allowed[t] and (stem[t] or not stems_only)
            ]
            return min(found, default=None)

        table, terms_, edits = [[0] * (len(symbols) + 1)], [-1], [0]
        number: dict = {}
        todo: list = []

        def state_of(state):
            if not state:
                return 0
            hit = accepted(state, True)
            key = ("stem", hit) if hit else state
            if key not in number:
                number[key] = len(table)
                table.append([0] * (len(symbols) + 1))
                end = hit or accepted(state, False)
                terms_.append(end[1] if end else -1)
                edits.append(end[0] if end else 0)
                if hit:
                    table[-1] = [number[key]] * (len(symbols) + 1)
                else:
                    todo.append((number[key], state))
            return number[key]

        self.start = state_of(closed([(0, 0)])) if terms else 0
        while todo:
            n, state = todo.pop()
            for s, b in enumerate([None, *symbols]):
                nxt = []
                for node, e in state:
                    if b in nodes[node]:
                        nxt.append((nodes[node][b], e))
                    nxt.append((node, e + 1))  # an inserted byte
                    nxt += [(c, e + 1) for x, c in nodes[node].items() if x != b]  # a substituted byte
                table[n][s] = state_of(closed(nxt))
        self.step = np.array(table, dtype=np.int32)
        self.term = np.array(terms_, dtype=np.int32)
        self.edits = np.array(edits, dtype=np.int32)

    def walk(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        """(word numbers, terms, edits) of the words that match."""
        live = np.arange(len(starts))
        state = np.full(len(starts), self.start, dtype=np.int32)
        final = np.zeros(len(starts), dtype=np.int32)
        at = 0
        while len(live) and self.start:
            over = starts[live] + at >= ends[live]
            final[live[over]] = state[over]
            live, state = live[~over], state[~over]
            state = self.step[state, self.symbol[buf[starts[live] + at]]]
            on = state > 0
            live, state = live[on], state[on]
            at += 1
        hit = np.flatnonzero(self.term[final] >= 0)
        return hit, self.term[final[hit]], self.edits[final[hit]]


def word_bounds(buf: np.ndarray):
    inside = _IS_WORD[buf]
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if len(inside) and inside[0]:
        edge = np.concatenate(([0], edge))
    return edge[0::2], edge[1::2]


def is_quoted(before: bytes, after: bytes) -> bool:
    """Whether the window around a match marks it as quotation: an odd number of
    marks before it in the window and one after it, or a word of reporting."""
    before_, after_ = before.decode("utf-8", "replace"), after.decode("utf-8", "replace")
    near = set(WORDS.findall(before)) | set(WORDS.findall(after))
    if any(w.decode("utf-8", "replace") in REPORTING for w in near):
        return True
    return len(MARKS.findall(before_)) % 2 == 1 and bool(MARKS.search(after_))


def matches(texts, automaton: Automaton) -> list[dict]:
    """How often each text holds each kind of match (term, edits, quoted)."""
    buf, first, lens = joined(texts)
    starts, ends = word_bounds(buf)
    hit, term, edits = automaton.walk(buf, starts, ends)
    out: list[dict] = [{} for _ in first]
    doc = np.searchsorted(first, starts[hit], side="right") - 1
    for w, t, e, d in zip(hit.tolist(), term.tolist(), edits.tolist(), doc.tolist(), strict=True):
        lo = max(int(starts[max(0, w - WINDOW)]), int(first[d]))
        hi = min(int(ends[min(len(ends) - 1, w + WINDOW)]), int(first[d] + lens[d]))
        # one more byte on each side, for marks that touch the outer words
        lo, hi = max(lo - 1, int(first[d])), min(hi + 1, int(first[d] + lens[d]))
        kind = (t, e, is_quoted(buf[lo : starts[w]].tobytes(), buf[ends[w] : hi].tobytes()))
        out[d][kind] = out[d].get(kind, 0) + 1
    return out


def evidence(toxic, other, n_toxic: int, n_other: int):
    """Log-likelihood gain of a pattern's toxic share over the usual share; 0
    where its documents are not toxic far more often."""
    toxic, other = np.asarray(toxic, dtype=np.float64), np.asarray(other, dtype=np.float64)
    n, usual = np.maximum(toxic + other, 1e-9), n_toxic / (n_toxic + n_other)
    part = lambda x, p: x * np.log(np.maximum(x, 1e-9) / (n * p))
    mostly = toxic * n_other >= 4 * (other + 0.5) * n_toxic
    return np.where(mostly, part(toxic, usual) + part(other, 1 - usual), 0.0)


def choose_terms(patterns: list[str], rows: list[np.ndarray], toxic: np.ndarray) -> list[str]:
    """Lexicon by greedy cover: again and again the pattern with the most
    evidence on the documents that no chosen pattern explains.  ``rows`` holds
    the documents (positions in ``toxic``) of each pattern.  Of equals, whole
    words come before stems, and longer stems before shorter ones."""
    open_ = np.ones(len(toxic), dtype=bool)
    order = sorted(range(len(patterns)), key=lambda i: (patterns[i].endswith("*"), -len(patterns[i]), patterns[i]))
    flat = np.concatenate([rows[i] for i in order]) if order else np.empty(0, dtype=np.int64)
    owner = np.repeat(np.arange(len(order)), [len(rows[i]) for i in order])
    chosen: list[str] = []
    while len(chosen) < MAX_TERMS and len(flat):
        n_toxic, n_other = int((toxic & open_).sum()), int((~toxic & open_).sum())
        if not n_toxic or not n_other:
            break
        hits = np.bincount(owner, weights=toxic[flat] & open_[flat], minlength=len(order))
        others = np.bincount(owner, weights=~toxic[flat] & open_[flat], minlength=len(order))
        gain = evidence(hits, others, n_toxic, n_other)
        best = int(np.argmax(np.round(gain, 6)))
        if gain[best] < MIN_EVIDENCE:
            break
        chosen.append(patterns[order[best]])
        open_[rows[order[best]]] = False
    # further terms that stand with chosen ones in the sample, but may stand alone
    n_toxic, n_other = int(toxic.sum()), int((~toxic).sum())
    if len(flat) and n_toxic and n_other:
        hits = np.bincount(owner, weights=toxic[flat], minlength=len(order))
        others = np.bincount(owner, weights=~toxic[flat], minlength=len(order))
        gain = evidence(hits, others, n_toxic, n_other)
        for i in np.argsort(-np.round(gain, 6), kind="stable"):
            if gain[i] < 2 * MIN_EVIDENCE or len(chosen) >= MAX_TERMS:
                break
            body = patterns[order[i]].removesuffix("*")
            known = any(body.startswith(c.removesuffix("*")) or c.startswith(body) for c in chosen)
            if not known and hits[i] >= 0.95 * (hits[i] + others[i]):
                chosen.append(patterns[order[i]])
    return chosen


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights of a ridge logistic regression by Newton steps; column 0 is 1."""
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-3
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hess = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(hess, x.T @ (y - p) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


class Model:
    """``weights``: toxic share by kind of match; ``mix``: logistic weights of
    (1, pooled evidence, strongest weight, log of the number of matches); None
    where nothing could be learned."""

    def __init__(self, terms: list[str], weights: dict | None = None, mix: np.ndarray | None = None):
        self.terms, self.weights, self.mix = terms, weights or {}, mix
        self.automaton = Automaton(terms)

    def features(self, texts) -> np.ndarray:
        out = np.zeros((len(texts), 4))
        out[:, 0] = 1
        for i, kinds in enumerate(matches(texts, self.automaton)):
            if kinds:
                p = np.array([self.weights.get(k, PRIOR[k[1], k[2]]) for k in sorted(kinds)])
                out[i, 1:] = -np.log(1 - np.minimum(p, 0.99)).sum(), p.max(), np.log1p(sum(kinds.values()))
        return out

    def scores(self, texts) -> np.ndarray:
        if self.mix is None:
            return np.zeros(len(texts))
        return 1 / (1 + np.exp(-np.clip(self.features(texts) @ self.mix, -30, 30)))


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_FIT_ROWS) -> Model:
    """Model from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic).  Equal
    texts of the sample count once, so copies are no evidence."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where(
        "doc_id is not null and toxic in (0, 1)"
    )
    known = known.where(~held_out(F.col("doc_id"), FOLDS)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)  # the documented bound
    sample = written(
        docs.select("doc_id", "text")
        .join(F.broadcast(chosen), "doc_id")
        .groupBy(F.coalesce("text", F.lit("")).alias("text"))
        .agg(F.max("toxic").alias("toxic"), F.min("doc_id").alias("doc_id")),
        "toxic_sample",
    )
    classes = sample.select("doc_id", "toxic").toPandas()  # ids and labels of the bounded sample
    toxic = classes["toxic"].to_numpy() == 1
    n_toxic, n_other = int(toxic.sum()), int((~toxic).sum())
    if not n_toxic or not n_other:
        return Model([])
    chars = F.lit(r"[a-z0-9*@$\x{80}-\x{10FFFF}]+")
    ws = F.array_distinct(F.regexp_extract_all(F.lower("text"), chars, F.lit(0)))

    def stems(k: int):  # word beginnings of k characters
        long_enough = F.filter("w", lambda x: F.length(x) >= k)
        return F.transform(long_enough, lambda x: F.concat(F.substring(x, 1, k), F.lit("*")))

    words = F.filter("w", lambda x: F.length(x).between(3, 24))
    seen = (
        sample.select("doc_id", "toxic", ws.alias("w"))
        .select("doc_id", "toxic", F.explode(F.array_distinct(F.concat(words, *[stems(k) for k in STEM_SIZES]))).alias("pattern"))
    )
    counts = (
        seen.groupBy("pattern")
        .agg(F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("other"))
        .where(F.col("toxic") >= 3)
        .where(F.col("toxic") * n_other >= (F.col("other") + 0.5) * 4 * n_toxic)
        .orderBy(F.desc(F.col("toxic") / (1 + F.col("other") * n_toxic / n_other)), "pattern")
        .limit(MAX_PATTERNS)  # the strongest patterns compete for the lexicon
        .select("pattern")
    )
    at = pd.Series(np.arange(len(classes)), index=classes["doc_id"])
    held = seen.select("doc_id", "pattern").join(F.broadcast(counts), "pattern").groupBy("pattern").agg(F.collect_list("doc_id").alias("ids"))
    held = held.toPandas()  # at most MAX_PATTERNS lists of sample ids
    terms = choose_terms(held["pattern"].tolist(), [at[list(x)].to_numpy() for x in held["ids"]], toxic)
    model = Model(terms)

    def kinds(batches):
        for pdf in batches:
            rows = [
                (*kind, label)
                for label, found in zip(pdf["toxic"], matches(pdf["text"], model.automaton), strict=True)
                for kind in found
            ]
            yield pd.DataFrame(rows, columns=["term", "edits", "quoted", "toxic"])

    for r in (
        sample.mapInPandas(kinds, "term int, edits int, quoted boolean, toxic int")
        .groupBy("term", "edits", "quoted")
        .agg(F.sum("toxic").alias("toxic"), F.count("*").alias("n"))
        .collect()  # a row per kind of match: six per term at most
    ):
        prior = PRIOR[r["edits"], r["quoted"]]
        model.weights[r["term"], r["edits"], r["quoted"]] = (r["toxic"] + PRIOR_ROWS * prior) / (r["n"] + PRIOR_ROWS)

    def features(batches):
        for pdf in batches:
            x = model.features(pdf["text"])
            yield pd.DataFrame({"a": x[:, 1], "b": x[:, 2], "c": x[:, 3], "toxic": pdf["toxic"].to_numpy()})

    rows = sample.mapInPandas(features, "a double, b double, c double, toxic int").toPandas()  # the bounded sample
    x = np.column_stack([np.ones(len(rows)), rows[["a", "b", "c"]].to_numpy()])
    model.mix = fit_logistic(x, rows["toxic"].to_numpy().astype(float))
    return model


def score_toxicity(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_rows: int = MAX_FIT_ROWS
) -> DataFrame:
    """(doc_id, held_out, score, predicted), one row per document."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    model = fit(docs, labels, max_rows)

    def run(batches):
        for pdf in batches:
            for part in doc_chunks(pdf, "text"):
                score = model.scores(part["text"])
                out = pd.DataFrame({"held_out": held_out_py(part["doc_id"], FOLDS), "score": score})
                out.insert(0, "doc_id", part["doc_id"].astype("Int64").to_numpy())
                out["predicted"] = (score >= 0.5).astype(np.int32)
                yield out

    return docs.mapInPandas(run, "doc_id long, held_out boolean, score double, predicted int")
