"""Language-model scores by a hierarchical Pitman-Yor model.

The context restaurant of a word u seats the tokens that follow u; all context
restaurants share one parent, the word restaurant, whose customers are their
tables; its parent is uniform over the vocabulary and one unknown word.

Seating is sampled by blocked Gibbs: the number of tables of a pair is drawn at
once, whatever its count, from its law given the weight of a new table, a =
(strength + discount * tables) * parent's probability: a^t times the generalized
Stirling number of (count, t).  Draws are vectorized over all (context, word)
pairs of a task and seeded by the pair, so the result does not depend on how
pairs are dealt out.  While a restaurant is drawn, its
parent's probabilities and its number of tables are those of the round before
(the usual approximation of distributed sampling): in the first round every
pair has one table; its seating gives the word restaurant's customers of the
second round, whose samples' predictive probabilities are averaged.  A context's
probabilities are those of its own new seating, tables and total alike.

Spark's part: blocks of texts send their tokens, packed, to buckets by context;
buckets and the word table exchange sums of customers and tables, so what is
gathered grows with the corpus.  Contexts that hold more than a quarter of a
bucket's share of tokens (found by exact counts of each block's commonest words)
are split over all buckets by the pair, and their totals go through the word
table: those of a round before the next one, those of the last seating before the
probabilities.  Totals of the other contexts come back to their bucket with the
word table's replies.  So splitting changes no score.  The packed tokens are
shuffled once and that exchange is used by every round in one plan.

Defined cases: a null or empty text is one end token; null ids are scored, as
training rows or held out by the hash of an empty text; repeated rows are rows
of their own; without training tokens every token has probability 1; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txlake.llm.bpe import _pack, _unpack
from txlake.llm.common import buckets_for, doc_chunks, held_out_py, joined, mix64, span_hashes, text_bytes, word_spans

FOLDS = 10
BLOCK_CHARS = 4 << 20
#: Text bytes for each bucket of contexts and of words.
BUCKET_BYTES = 16 << 20
#: Discount and strength of the context restaurants and of the word restaurant.
DISCOUNT, STRENGTH = 0.8, 2.0
DISCOUNT0, STRENGTH0 = 0.7, 10.0
BURN, SAMPLES = 2, 2
#: Customers up to which a pair's law of tables is tabulated; larger counts are
#: brought down to it.
EXACT = 1024
HASH = np.uint64((1 << 56) - 1)
START, END = np.uint64(0x5354415254), np.uint64(0x454E44)


# --- seating -----------------------------------------------------------------


def _uniform(seed: np.ndarray, k: int) -> np.ndarray:
    return (mix64(seed + np.uint64((k * 0x9E3779B97F4A7C15) & (2**64 - 1))) >> np.uint64(11)) / float(1 << 53)


#: Laws made before, by discount (a plain dict, as functions travel by value).
_LAWS: dict[float, list[np.ndarray]] = {}


def _table_laws(d: float) -> list[np.ndarray]:
    if d not in _LAWS:
        _LAWS[d] = _make_laws(d)
    return _LAWS[d]


def _make_laws(d: float) -> list[np.ndarray]:
    """For n customers, the logarithm of q(n, t) / (t - 1)! for t = 1..n, where
    a^t S_d(n, t) is in proportion to (a / d)^(t - 1) / (t - 1)! * q(n, t) and
    q(n + 1, t) (n - d) = d (t - 1) q(n, t - 1) + (n - d t) q(n, t)."""
    q, out = np.zeros(1), [np.empty(0), np.zeros(1)]
    log_factorial = np.concatenate(([0.0], np.cumsum(np.log(np.arange(1, EXACT)))))
    with np.errstate(divide="ignore"):
        for n in range(1, EXACT):
            t = np.arange(1, n + 2)
            q = np.logaddexp(
                np.append(-np.inf, q) + np.log(d * (t - 1)), np.append(q, -np.inf) + np.log(np.maximum(n - d * t, 1e-300))
            ) - np.log(n - d)
            out.append(q - log_factorial[: n + 1])
    return out


def _draw(c: int, a: np.ndarray, u: np.ndarray, d: float) -> np.ndarray:
    """(samples, n) numbers of tables of n dishes with ``c`` customers each."""
    law = _table_laws(d)[c]
    out = np.empty(u.shape, dtype=np.int64)
    step = max(1, (1 << 18) // c)
    for i in range(0, len(a), step):
        w = np.log(np.maximum(a[i : i + step], 1e-300) / d)[:, None] * np.arange(c) + law
        w = np.cumsum(np.exp(w - w.max(axis=1, keepdims=True)), axis=1)
        for k in range(len(u)):
            out[k, i : i + step] = 1 + (w[:, :-1] <= (u[k, i : i + step] * w[:, -1])[:, None]).sum(axis=1)
    return out


def _draw_large(c: np.ndarray, a: np.ndarray, seed: np.ndarray, u: np.ndarray, d: float) -> np.ndarray:
    """The same for more than ``EXACT`` customers.  Seen backwards from c to EXACT
    customers, each table but one is left with the same probability pi, so t is a
    draw for EXACT customers and weight a * pi plus a Poisson number.  Where new
    tables are so likely that most steps add one (a > c / 10), t counts hundreds
    and is drawn from the normal limit of the law."""
    gamma = np.frompyfunc(math.lgamma, 1, 1)
    ln = lambda x: gamma(x).astype(np.float64)
    pi = np.exp(ln(c - 2 * d) - ln(c - d) + math.lgamma(EXACT - d) - math.lgamma(EXACT - 2 * d))
    few = a <= c / 10
    out = np.empty(u.shape, dtype=np.int64)
    out[:, few] = _draw(EXACT, (a * pi)[few], u[:, few], d)
    # a * x * (1 - x)^(d - 1) = c, where tables come as Poisson and sizes tilted by x
    low, high = np.zeros(len(c)), np.ones(len(c))
    for _ in range(60):
        x = (low + high) / 2
        more = a * x < c * (1 - x) ** (1 - d)
        low, high = np.where(more, x, low), np.where(more, high, x)
    mean = a / d * (1 - (1 - high) ** d)
    sd = np.sqrt(np.maximum(mean - c * (1 - high) / (1 - d * high), 0))
    for i in range(len(c)):
        rng = np.random.default_rng(int(seed[i]))
        if few[i]:
            out[:, i] += rng.poisson(a[i] * (1 - pi[i]) / d, len(u))
        else:
            out[:, i] = np.rint(mean[i] + sd[i] * rng.standard_normal(len(u)))
    return np.clip(out, 1, c)


def sample_tables(c, a, seed, d: float, burn: int = BURN, samples: int = SAMPLES) -> np.ndarray:
    """(samples, n) numbers of tables of n dishes with ``c`` customers each.

    ``a``: weight of a new table, (strength + d * tables) * parent probability;
    a table of s customers has weight s - d.  A dish's customers sit at tables of
    its own, so dishes are independent given ``a``, and draws are independent of
    each other; ``burn`` of them are passed over."""
    c = np.asarray(c, dtype=np.int64)
    out = np.repeat((c > 0).astype(np.int64)[None, :], samples, axis=0)
    many = np.flatnonzero(c > 1)
    if not len(many):
        return out
    many = many[np.argsort(c[many], kind="stable")]
    c, a, seed = c[many], np.asarray(a, dtype=np.float64)[many], np.asarray(seed, dtype=np.uint64)[many]
    u = np.stack([_uniform(mix64(seed), burn + k + 1) for k in range(samples)])
    ends = [*np.flatnonzero(np.diff(c, prepend=0)), len(c)]
    for i, j in zip(ends[:-1], ends[1:], strict=True):
        if c[i] > EXACT:
            out[:, many[i:]] = _draw_large(c[i:], a[i:], seed[i:], u[:, i:], d)
            break
        out[:, many[i:j]] = _draw(int(c[i]), a[i:j], u[:, i:j], d)
    return out


# --- packed tokens -----------------------------------------------------------


def block_tokens(texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(previous word, word, text number) of every token; each text ends with END."""
    buf, starts, _ = joined(texts)
    s, e = word_spans(buf)
    doc = np.searchsorted(starts, s, side="right") - 1
    n = len(starts)
    w = np.full(len(s) + n, END, dtype=np.uint64)
    w[np.arange(len(s)) + doc] = span_hashes(buf, s, e) & HASH
    of = np.repeat(np.arange(n), np.bincount(doc, minlength=n) + 1)
    u = np.empty_like(w)
    u[1:] = w[:-1]
    u[np.searchsorted(of, np.arange(n))] = START
    return u, w, of


def _commonest(n_buckets: int):
    def run(batches):
        for pdf in batches:
            for part in doc_chunks(pdf, "text", BLOCK_CHARS):
                u, n = np.unique(block_tokens(part["text"])[0], return_counts=True)
                big = n * 8 * n_buckets >= n.sum()
                yield pd.DataFrame({"u": np.append(u[big].astype(np.int64), -1), "n": np.append(n[big], n.sum())})

    return run


def hot_contexts(docs: DataFrame, n_buckets: int) -> np.ndarray:
    """Contexts with more than a quarter of a bucket's share of tokens: at most
    four for each bucket.  A context that common is at least half as common in
    some blocks, and is counted there."""
    counts = docs.select("text").mapInPandas(_commonest(n_buckets), "u long, n long").groupBy("u").agg(F.sum("n").alias("n"))
    total = counts.where("u = -1").first()
    if total is None:
        return np.empty(0, dtype=np.uint64)
    hot = counts.where((F.col("u") >= 0) & (F.col("n") * 4 * n_buckets > total["n"])).select("u").toPandas()
    return np.sort(hot["u"].to_numpy(dtype=np.int64).astype(np.uint64))


def _member(x: np.ndarray, sorted_: np.ndarray) -> np.ndarray:
    if not len(sorted_):
        return np.zeros(len(x), dtype=bool)
    return sorted_[np.minimum(np.searchsorted(sorted_, x), len(sorted_) - 1)] == x


#: ``texts``: numbers in the block of the texts that have tokens in the row, ``train``:
#: whether they train, ``doc``: positions in ``texts``.  The ids of all texts of a block
#: and whether they are held out travel once, with its first row.
TOKENS = (
    "bucket int, block long, ids array<long>, held binary, texts binary, train binary, words binary, u binary, w binary, doc binary"
)


def _tokens(n_buckets: int, hot: np.ndarray):
    def run(batches):
        from pyspark import TaskContext

        part, seq = TaskContext.get().partitionId(), 0
        for pdf in batches:
            for chunk in doc_chunks(pdf, "text", BLOCK_CHARS):
                block, seq = (part << 32) | seq, seq + 1
                ids = [None if d is None or d != d else int(d) for d in chunk["doc_id"]]
                held = held_out_py(chunk["doc_id"], FOLDS).astype(np.uint8)
                u, w, doc = block_tokens(chunk["text"])
                key = np.where(_member(u, hot), mix64(u * np.uint64(3) + w), mix64(u))
                bucket = (key % np.uint64(n_buckets)).astype(np.int32)
                order = np.lexsort((doc, w, u, bucket))
                ends = np.searchsorted(bucket[order], np.arange(n_buckets + 1))
                rows = []
                for b in range(n_buckets):
                    mine = order[ends[b] : ends[b + 1]]
                    if not len(mine):
                        continue
                    words, code = np.unique(np.concatenate((u[mine], w[mine])), return_inverse=True)
                    code = code.astype(np.uint32)
                    texts, at = np.unique(doc[mine], return_inverse=True)
                    whole = (None, None) if rows else (ids, _pack(held))
                    mates = _pack(np.diff(texts.astype(np.uint32), prepend=np.uint32(0))), _pack(1 - held[texts])
                    rows.append(
                        (b, block, *whole, *mates, _pack(np.diff(words, prepend=np.uint64(0))), _pack(np.diff(code[: len(mine)], prepend=np.uint32(0))), _pack(code[len(mine) :]), _pack(at.astype(np.uint32)))
                    )
                yield pd.DataFrame(rows, columns=["bucket", "block", "ids", "held", "texts", "train", "words", "u", "w", "doc"])

    return run


class Bucket:
    """The tokens of a bucket: pairs with their training counts."""

    def __init__(self, pdf: pd.DataFrame, hot: np.ndarray):
        self.rows = pdf.sort_values("block").reset_index(drop=True)
        lists = [np.cumsum(_unpack(x, np.uint64), dtype=np.uint64) for x in self.rows["words"]]
        self.words = np.unique(np.concatenate(lists))
        n = len(self.words)
        keys, train = [], []
        for words, u, w, doc, trains in zip(lists, self.rows["u"], self.rows["w"], self.rows["doc"], self.rows["train"], strict=True):
            code = np.searchsorted(self.words, words)
            keys.append(code[np.cumsum(_unpack(u, np.uint32), dtype=np.uint32)] * n + code[_unpack(w, np.uint32)])
            train.append(_unpack(trains, np.uint8)[_unpack(doc, np.uint32)] > 0)
        pair, self.of = np.unique(np.concatenate(keys), return_inverse=True)
        self.u, self.w = pair // n, pair % n
        self.c = np.bincount(self.of, weights=np.concatenate(train), minlength=len(pair)).astype(np.int64)
        self.seed = mix64(self.words[self.u] * np.uint64(0x9E3779B97F4A7C15) + self.words[self.w])
        self.is_hot = _member(self.words, hot)
        dishes = np.unique(self.w)
        hots = np.unique(self.u[self.is_hot[self.u]])
        # names in the word table: dishes are even, split contexts odd
        self.dishes, self.hots = dishes, hots
        self.names = np.concatenate((self.words[dishes] << np.uint64(1), (self.words[hots] << np.uint64(1)) | np.uint64(1)))

    def sums(self, per_pair: np.ndarray) -> np.ndarray:
        """Sums of a number per pair, for each name."""
        n = len(self.words)
        return np.concatenate(
            (np.bincount(self.w, weights=per_pair, minlength=n)[self.dishes], np.bincount(self.u, weights=per_pair, minlength=n)[self.hots])
        )

    def contexts(self, per_pair: np.ndarray, hot_totals: np.ndarray | None) -> np.ndarray:
        """Sums for each pair's context; split contexts take the given totals."""
        total = np.bincount(self.u, weights=per_pair, minlength=len(self.words))
        if hot_totals is not None:
            total[self.hots] = hot_totals
        return total[self.u]


SUMS = "part int, bucket int, names binary, tables binary, customers binary, own binary"
REPLY = "bucket int, part int, customers binary, tables binary, parents binary, totals array<double>, own binary, last binary"


def _sum_rows(bucket: int, b: Bucket, tables: np.ndarray, n_parts: int) -> pd.DataFrame:
    t, c = b.sums(tables), b.sums(b.c)
    part = mix64(b.names >> np.uint64(1)) % np.uint64(n_parts)
    # the totals of the bucket's contexts, brought back as they are by one part
    own = _pack(np.bincount(b.u, weights=tables, minlength=len(b.words)).astype(np.uint64))
    rows = []
    for p in range(n_parts):  # an empty row, too, brings that part's totals back
        mine = np.flatnonzero(part == p)
        mine = mine[np.argsort(b.names[mine])]
        rows.append((p, bucket, _pack(np.diff(b.names[mine], prepend=np.uint64(0))), _pack(t[mine].round().astype(np.uint64)), _pack(c[mine].round().astype(np.uint64)), own if p == bucket % n_parts else None))
    return pd.DataFrame(rows, columns=["part", "bucket", "names", "tables", "customers", "own"])


def _first_sums(hot: np.ndarray, n_parts: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        b = Bucket(pdf, hot)
        return _sum_rows(int(pdf["bucket"].iloc[0]), b, (b.c > 0).astype(np.int64), n_parts)

    return run


def _word_table(n_parts: int):
    """Totals by name, the word restaurant's seating, and replies to the buckets."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        names = [np.cumsum(_unpack(x, np.uint64), dtype=np.uint64) for x in pdf["names"]]
        every, of = np.unique(np.concatenate(names), return_inverse=True)
        add = lambda col: np.bincount(of, weights=np.concatenate([_unpack(x, np.uint64) for x in pdf[col]]), minlength=len(every))
        tables, customers = add("tables"), add("customers")
        dish = every & np.uint64(1) == 0
        known = dish & (customers > 0)
        v = int(known.sum())
        # about this part's share of the vocabulary and of the parent's tables
        new = (STRENGTH0 + DISCOUNT0 * v * n_parts) / (v * n_parts + 1)
        parents = np.zeros((SAMPLES, len(every)), dtype=np.int64)
        parents[:, known] = sample_tables(tables[known], np.full(v, new), mix64(every[known]), DISCOUNT0)
        totals = [float(v), customers[known].sum(), tables[known].sum(), *parents[:, known].sum(axis=1).astype(float)]
        ends = np.cumsum([0] + [len(x) for x in names])
        rows = []
        for bucket, i, j in zip(pdf["bucket"], ends[:-1], ends[1:], strict=True):
            x = of[i:j]
            rows.append((bucket, pdf["part"].iloc[0], _pack(customers[x].astype(np.uint64)), _pack(tables[x].astype(np.uint64)), _pack(parents[:, x].astype(np.uint64).ravel()), totals))
        out = pd.DataFrame(rows, columns=["bucket", "part", "customers", "tables", "parents", "totals"])
        return out.assign(own=pdf["own"].to_numpy(), last=None)

    return run


class Parent:
    """What a bucket learns from the word table, in the order of its names."""

    def __init__(self, b: Bucket, replies: pd.DataFrame, n_parts: int):
        n, d = len(b.names), len(b.dishes)
        customers, tables, seated = np.zeros(n), np.zeros(n), np.zeros((SAMPLES, n))
        totals = np.zeros(3 + SAMPLES)
        part = mix64(b.names >> np.uint64(1)) % np.uint64(n_parts)
        own, self.last = np.zeros(len(b.words)), np.zeros((SAMPLES, len(b.hots)))
        for r in replies.itertuples(index=False):
            if r.last is not None:
                u, t = _unpack(r.last, np.uint64).reshape(2, SAMPLES, -1)
                at = np.searchsorted(u[0], b.words[b.hots])
                self.last = t[:, at].astype(float)
                continue
            if r.own is not None:
                own = _unpack(r.own, np.uint64).astype(float)
            mine = np.flatnonzero(part == r.part)
            mine = mine[np.argsort(b.names[mine])]
            customers[mine] = _unpack(r.customers, np.uint64)
            tables[mine] = _unpack(r.tables, np.uint64)
            seated[:, mine] = _unpack(r.parents, np.uint64).reshape(SAMPLES, -1)
            totals += np.asarray(r.totals)
        self.vocabulary, self.tokens = totals[0], totals[1]
        self.hot_customers, self.hot_tables = customers[d:], tables[d:]
        #: tables of each pair's context after the round before
        self.tables = own
        self.tables[b.hots] = self.hot_tables
        self.tables = self.tables[b.u]
        self.counts = np.zeros(len(b.words))  # training tokens of each word
        self.counts[b.dishes] = customers[:d]
        below = (STRENGTH0 + DISCOUNT0 * totals[3:]) / (STRENGTH0 + totals[2]) / (self.vocabulary + 1)
        own = np.maximum(tables[:d] - DISCOUNT0 * seated[:, :d], 0) / (STRENGTH0 + totals[2])
        #: (samples, words): the word restaurant's predictive probabilities
        self.p = np.zeros((SAMPLES, len(b.words)))
        self.p[:, b.dishes] = own + below[:, None]


def _sampled(b: Bucket, parent: Parent) -> np.ndarray:
    """(samples, pairs) numbers of tables, given those of the round before."""
    a = (STRENGTH + DISCOUNT * parent.tables) * parent.p.mean(axis=0)[b.w]
    return sample_tables(b.c, a, b.seed, DISCOUNT)


def _second_sums(hot: np.ndarray, n_parts: int):
    def run(tokens: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        b = Bucket(tokens, hot)
        parent = Parent(b, replies, n_parts)
        return _sum_rows(int(tokens["bucket"].iloc[0]), b, _sampled(b, parent)[-1], n_parts)

    return run


LAST = "u long, tables array<long>"


def _last_sums(hot: np.ndarray, n_parts: int):
    """Tables of the split contexts after the last seating, by sample."""

    def run(tokens: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        b = Bucket(tokens, hot)
        seated = _sampled(b, Parent(b, replies, n_parts))
        t = np.stack([np.bincount(b.u, weights=x, minlength=len(b.words))[b.hots] for x in seated], axis=1)
        return pd.DataFrame({"u": b.words[b.hots].astype(np.int64), "tables": list(t.astype(np.int64))})

    return run


def _last_reply(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("u")
    t = np.stack(pdf["tables"].tolist(), axis=1).astype(np.uint64)
    u = np.broadcast_to(pdf["u"].to_numpy().astype(np.uint64), t.shape)
    return pd.DataFrame({"last": [_pack(np.concatenate((u, t)).ravel())]})


SCORES = "block long, ids array<long>, held binary, texts binary, n binary, known binary, base binary, score binary, train long"


def _scores(hot: np.ndarray, n_parts: int):
    def run(tokens: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        if not len(tokens):
            return pd.DataFrame(columns=["block", "ids", "held", "texts", "n", "known", "base", "score", "train"])
        b = Bucket(tokens, hot)
        parent = Parent(b, replies, n_parts)
        seated = _sampled(b, parent)
        c_u = b.contexts(b.c, parent.hot_customers)
        p = np.zeros(len(b.c))
        for s in range(SAMPLES):
            t_u = b.contexts(seated[s], parent.last[s])
            own = np.maximum(b.c - DISCOUNT * seated[s], 0)
            p += (own + (STRENGTH + DISCOUNT * t_u) * parent.p[s][b.w]) / (STRENGTH + c_u)
        logp = np.log10(np.maximum(p / SAMPLES, 1e-300))
        counts = parent.counts[b.w]
        base = np.log10((counts + 0.1) / (parent.tokens + 0.1 * (parent.vocabulary + 1)))
        out, at = [], 0
        for r in b.rows.itertuples(index=False):
            doc = _unpack(r.doc, np.uint32)
            of, n = b.of[at : at + len(doc)], int(doc.max()) + 1
            at += len(doc)
            per = lambda x: np.bincount(doc, weights=x, minlength=n)  # noqa: E731, B023
            out.append(
                (r.block, r.ids, r.held, r.texts, _pack(np.bincount(doc, minlength=n).astype(np.uint32)), _pack(per(counts[of] > 0).astype(np.uint32)), _pack(per(base[of])), _pack(per(logp[of])), int(parent.tokens))
            )
        return pd.DataFrame(out, columns=["block", "ids", "held", "texts", "n", "known", "base", "score", "train"])

    return run


def _add_up(pdf: pd.DataFrame) -> pd.DataFrame:
    first = pdf[pdf["held"].notna()].iloc[0]
    held = _unpack(first["held"], np.uint8) > 0
    texts = np.concatenate([np.cumsum(_unpack(x, np.uint32), dtype=np.uint32) for x in pdf["texts"]])
    total = lambda col, kind: np.bincount(texts, weights=np.concatenate([_unpack(x, kind) for x in pdf[col]]), minlength=len(held))
    out = pd.DataFrame(
        {
            "held_out": held,
            "n_tokens": total("n", np.uint32).astype(np.int64),
            "n_known": total("known", np.uint32).astype(np.int64),
            "train_tokens": int(first["train"]),
            "base_score": total("base", np.float64),
            "score": total("score", np.float64),
        }
    )
    ids = pd.array([None if i is None or i != i else int(i) for i in first["ids"]], dtype="Int64")
    out.insert(0, "doc_id", ids)
    return out


def language_model_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score): one
    row per document; a text's perplexity is 10 ** (-score / n_tokens)."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    n_buckets = n_parts = buckets_for(text_bytes(docs), BUCKET_BYTES)
    hot = hot_contexts(docs, n_buckets)
    tokens = docs.mapInPandas(_tokens(n_buckets, hot), TOKENS)
    by_bucket = lambda df: df.groupBy("bucket")
    table = lambda sums: sums.groupBy("part").applyInPandas(_word_table(n_parts), REPLY)
    replies = table(by_bucket(tokens).applyInPandas(_first_sums(hot, n_parts), SUMS))
    replies = table(by_bucket(tokens).cogroup(by_bucket(replies)).applyInPandas(_second_sums(hot, n_parts), SUMS))
    if len(hot):
        last = by_bucket(tokens).cogroup(by_bucket(replies)).applyInPandas(_last_sums(hot, n_parts), LAST)
        sums = [F.sum(F.col("tables")[s]).alias(f"t{s}") for s in range(SAMPLES)]
        last = last.groupBy("u").agg(*sums).select("u", F.array(*[f"t{s}" for s in range(SAMPLES)]).alias("tables"))
        # at most four split contexts for each bucket; all totals go to every bucket
        last = last.groupBy(F.lit(0).alias("all")).applyInPandas(_last_reply, "last binary")
        last = last.select(F.explode(F.sequence(F.lit(0), F.lit(n_buckets - 1))).alias("bucket"), F.lit(-1).alias("part"), "last")
        replies = replies.unionByName(last, allowMissingColumns=True)
    scores = by_bucket(tokens).cogroup(by_bucket(replies)).applyInPandas(_scores(hot, n_parts), SCORES)
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return scores.groupBy("block").applyInPandas(_add_up, schema)
