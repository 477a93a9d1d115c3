"""Quality and toxicity: held-out accuracy, automaton against edit distance."""

import numpy as np
import pytest
from llm_cases import docs, edge_rows

from txlake.llm import quality, toxicity
from txlake.llm.common import joined, table

LABELLED = "/root/testdata/sf0.01"


def auc(score, y):
    score, y = np.asarray(score), np.asarray(y)
    order = score.argsort().argsort()
    pos = y == 1
    return (order[pos].sum() - pos.sum() * (pos.sum() - 1) / 2) / max(1, pos.sum() * (~pos).sum())


@pytest.mark.parametrize(("score", "label", "least"), [(quality.score_quality, "quality", 0.95), (toxicity.score_toxicity, "toxic", 0.75)])
def test_held_out_accuracy(spark, score, label, least):
    frame, labels = table(spark, LABELLED, "documents"), table(spark, LABELLED, "labels")
    rows = score(frame, labels).join(labels, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert held and auc([r.score for r in held], [r[label] for r in held]) >= least
    assert all(0 <= r.score <= 1 for r in rows)


@pytest.mark.parametrize("score", [quality.score_quality, toxicity.score_toxicity])
def test_edge_rows(spark, score):
    labels = spark.createDataFrame([(i, i % 2, (i + 1) % 2) for i in range(1, 12)] + [(None, 1, 1), (4, None, None)], "doc_id long, quality int, toxic int")
    rows = edge_rows()
    result = score(docs(spark, rows), labels).collect()
    assert sorted(str(r.doc_id) for r in result) == sorted(str(r[0]) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in result)
    by_id = {}
    for r in result:  # equal rows score alike
        assert by_id.setdefault(r.doc_id, r.score) == r.score or r.doc_id is None
    assert score(docs(spark, []), labels).collect() == []
    none = score(docs(spark, rows), labels.limit(0)).collect()
    assert len({r.score for r in none}) == 1


def test_network_covers_the_whole_text():
    """A change at the very end of a long text changes its score."""
    net = quality.Network()
    a, b = net.scores(["abc " * 5000, "abc " * 5000 + "%%%! " * 20])
    assert a != b
    alone = net.scores(["abc " * 5000])
    assert np.allclose(alone, a)  # no influence of neighbours


def edits(a: bytes, b: bytes) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def test_automaton_equals_edit_distance():
    rng = np.random.default_rng(2)
    terms = ["scum", "loser", "pathetic", "worthless", "stem*", "verylongstem*"]
    automaton = toxicity.Automaton(terms)
    texts = []
    for t in terms:
        for _ in range(150):
            w = list(t.rstrip("*"))
            for _ in range(rng.integers(0, 4)):
                at = int(rng.integers(0, len(w) + 1))
                w[at : at + int(rng.integers(0, 2))] = list("abcestx"[int(rng.integers(0, 7))])[: int(rng.integers(0, 2))]
            texts.append("".join(w))
    texts = [t for t in texts if t]
    buf, starts, lens = joined(texts)
    hit, term, k = automaton.walk(buf, starts, starts + lens)
    found = dict(zip(hit.tolist(), zip(term.tolist(), k.tolist(), strict=True), strict=True))
    for i, word in enumerate(texts):
        w, best = word.encode(), None
        for n, t in enumerate(terms):
            allowed, body = toxicity.edits_allowed(t), t.rstrip("*").encode()
            reach = min(edits(body, w[:m]) for m in range(len(w) + 1)) if t.endswith("*") else edits(body, w)
            if reach <= allowed and (best is None or reach < best[0]):
                best = (reach, n)
        assert (best is None) == (i not in found), word
        if best is not None and not any(t.endswith("*") for t in (terms[best[1]], terms[found[i][0]])):
            assert found[i][1] == best[0]


def test_quotation_lowers_the_score():
    model = toxicity.Model(["idiot"], {(0, 0, False): 0.98, (0, 0, True): 0.1}, np.array([-2.0, 1.5, 1.0, 0.2]))
    plain, quoted, misspelled, clean = model.scores(["you are an idiot here", 'she said "an idiot" here', "you are an id1ot here", "all is well"])
    assert plain > 0.5 > quoted and misspelled > 0.5 > clean


def plain_logit(net, text):
    """The network by loops: every filter at every second byte of every chunk."""
    raw = text.encode()
    halves = -(-(len(raw) + quality.WIDTH) // quality.HALF)
    data = raw + bytes(halves * quality.HALF + quality.WIDTH - len(raw))
    total = []
    for c in range(max(halves - 1, 1)):
        z = float(net.p["base"][0])
        for f in range(quality.FILTERS):
            best = -np.inf
            for at in range(c * quality.HALF, min((c + 2) * quality.HALF, halves * quality.HALF), quality.STEP):
                if at + quality.WIDTH > halves * quality.HALF:
                    continue  # reaches into the next text
                best = max(best, sum(float(net.p["table"][k, data[at + k], f]) for k in range(quality.WIDTH)))
            z += max(best + float(net.p["bias"][f]), 0.0) * float(net.p["out"][f])
        total.append(z)
    return sum(total) / len(total)


def test_network_equals_loops(monkeypatch):
    monkeypatch.setattr(quality, "BLOCK", 2 * quality.HALF)
    net = quality.Network()
    texts = ["", "a", "ünïcode words " * 7, "abc def. " * 90, "x" * quality.HALF, "y" * (quality.HALF - quality.WIDTH)]
    assert np.allclose(net.logits(texts), [plain_logit(net, t) for t in texts], atol=1e-3)


def test_gradients_do_not_depend_on_blocks(monkeypatch):
    net, y = quality.Network(), np.array([1.0, 0.0], dtype=np.float32)
    texts = ["some words of one text " * 60, "other words " * 200]
    whole = net.gradients(texts, y)
    monkeypatch.setattr(quality, "BLOCK", 2 * quality.HALF)
    blocks = net.gradients(texts, y)
    assert all(np.allclose(whole[k], blocks[k], atol=1e-6) for k in whole)


def test_long_labelled_texts_are_fitted(spark):
    assert quality.admitted([5, 9, 3, 1], 9) == [0, 2, 3]
    rows = [(i, ("good words here " if i % 2 else "%%$ zz#! ") * 4_000) for i in range(1, 40)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 40)], "doc_id long, quality int")
    got = {r.doc_id: r.score for r in quality.score_quality(docs(spark, rows), labels).collect()}
    assert min(got[i] for i in got if i % 2) > 0.5 > max(got[i] for i in got if not i % 2)
