"""The registered queries against their SQL, whole tables."""

import hashlib
import random
import re

import oracle
import pytest

from filmgrain.llm import pii, queries, syncmers


@pytest.fixture(scope="module")
def con(folder):
    return oracle.connect(folder)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_matches_sql(spark, folder, con, name):
    problem, _, _, _ = oracle.compare(spark, name, queries.QUERIES[name], queries.SQL[name], folder, con)
    assert problem is None, problem


def documents(spark, folder):
    return {r.doc_id: r for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_base(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if (kind == "ip" and any(int(p) > 255 for p in m[0].split("."))) or (
                    kind == "card" and not (16 <= len(digits) <= 19 and pii.luhn(digits))) or (
                    kind == "phone" and not 8 <= len(digits) <= 15):
                continue
            out.append((kind, m.start(), m.end()))
    return out


def test_base_spans_of_documents(spark, folder):
    docs = documents(spark, folder)
    for r in queries.op1_crf_pii(spark, folder).collect():
        base = plain_base(docs[r.doc_id].text or "")
        listed = [f"{k}:{a}:{b}" for k, a, b in base]
        assert r.base_sha256 == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert set(listed) <= set(r.spans.split(",")) | ({""} if not listed else set())
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x for k, _, _ in base) for x in pii.KINDS]


def test_held_out_accuracy(spark, folder):
    docs = documents(spark, folder)
    held = [r for r in queries.op2_ngram_filters(spark, folder).collect() if r.held_out]
    assert held and sum(r.lang_pred == docs[r.doc_id].lang for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in held)


def test_fingerprints_beside_the_next_document(spark, folder):
    docs = sorted(documents(spark, folder).values(), key=lambda r: r.doc_id)
    found = {r.doc_id: r for r in queries.op7_syncmer_fingerprints(spark, folder).collect()}
    assert len(found) == len(docs)
    for now, after in zip(docs, docs[1:] + docs[:1]):
        r, tail = found[now.doc_id], len(now.text) // 4
        edited = now.text[:len(now.text) - tail] + after.text[:tail]
        assert (r.n_chars, r.edited_sha256) == (len(now.text), hashlib.sha256(edited.encode()).hexdigest())
        assert r.fingerprint == syncmers.written(syncmers.sketch(now.text))
        assert r.edited_fingerprint == syncmers.written(syncmers.sketch(edited))
    rows = list(found.values())
    assert sum(r.near_edited for r in rows) / len(rows) > 0.5 > 0.05 > sum(r.near_next for r in rows) / len(rows)


def test_pieces_restore_every_text(spark, folder):
    rows = queries.op9_viterbi_pieces(spark, folder).collect()
    assert rows and all(r.restored and r.n_pieces > 0 for r in rows)


def test_near_duplicate_classes(spark, folder):
    """Against all pairs, by the same weights."""
    import numpy as np

    from filmgrain.llm import weighted_minhash as w

    docs = {i: r.text for i, r in documents(spark, folder).items()}
    features = {i: dict(zip(*(x.tolist() for x in w.shingles(w.plain_words(t))))) for i, t in docs.items()}
    frequency = np.zeros(w.SLOTS, dtype=np.int64)
    for f in features.values():
        frequency[np.unique(w.slots(np.array(list(f), dtype=np.uint64)))] += 1
    weight = w.idf(frequency, len(docs))
    weights = {k: float(weight[w.slots(np.array([k], dtype=np.uint64))[0]]) for f in features.values() for k in f}
    parent = {i: i for i in docs}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    total = {i: sum(n * weights[k] for k, n in f.items()) for i, f in features.items()}
    order = sorted(docs)
    for n, a in enumerate(order):
        for b in order[:n]:
            common = sum(min(c, features[b][k]) * weights[k] for k, c in features[a].items() if k in features[b])
            if common >= w.THRESHOLD * (total[a] + total[b] - common):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    got = {r.doc_id: r for r in queries.op5_weighted_minhash(spark, folder).collect()}
    assert {i: r.class_id for i, r in got.items()} == {i: find(i) for i in docs}
    assert {i for i, r in got.items() if r.kept} == {find(i) for i in docs}


def test_linear_email_scan():
    rng = random.Random(4)
    for _ in range(3000):
        text = "".join(rng.choice("ab.@-1 +") for _ in range(rng.randint(0, 40)))
        assert [("email", *s) for s in pii.emails(text)] == [s for s in plain_base(text) if s[0] == "email"], text
        assert pii.base_spans(text) == plain_base(text), text


def plain_syncmers(text, k=syncmers.K, s=syncmers.S):
    """(position, k-mer) of the k-mers whose smallest inner substring, by the operator's order, lies at an edge."""
    import numpy as np

    from filmgrain.llm.arrays import mix

    base, mask = int(syncmers._BASE), 2**64 - 1
    value = {}

    def order(part):
        if part not in value:
            total = sum((ord(c) + 1) * pow(base, i, 2**64) for i, c in enumerate(part)) & mask
            value[part] = int(mix(np.array([total], dtype=np.uint64))[0])
        return value[part]

    out = []
    for i in range(len(text) - k + 1):
        inner = [order(text[j:j + s]) for j in range(i, i + k - s + 1)]
        if min(inner) in (inner[0], inner[-1]):
            out.append((i, text[i:i + k]))
    return out


def test_syncmers_one_by_one():
    rng = random.Random(8)
    texts = ["", "short", "a" * 60, "ab" * 50, "é\U0001F600" * 40] + [
        "".join(rng.choice("abcd é\n") for _ in range(rng.randint(10, 400))) for _ in range(40)]
    for text in texts:
        where, what = syncmers.anchors(text)
        plain = plain_syncmers(text)
        assert where.tolist() == [i for i, _ in plain], text
        # equal k-mers have equal hashes, different ones different hashes
        names = {}
        for (_, mer), h in zip(plain, what.tolist()):
            assert names.setdefault(mer, h) == h
        assert len(set(names.values())) == len(names)


def test_syncmers_over_pieces(monkeypatch):
    rng = random.Random(3)
    text = "".join(rng.choice("abcdef ") for _ in range(3000))
    whole = syncmers.anchors(text)
    monkeypatch.setattr(syncmers, "PIECE", 128)
    cut = syncmers.anchors(text)
    assert whole[0].tolist() == cut[0].tolist() and whole[1].tolist() == cut[1].tolist()


def test_likeness_bounds_by_shared_syncmers():
    """Never above the share of syncmers that two texts have in common at all, and all of it for a plain shift."""
    from collections import Counter

    rng = random.Random(12)
    for _ in range(60):
        a = "".join(rng.choice("abcdefgh ") for _ in range(rng.randint(50, 600)))
        at = rng.randint(0, len(a))
        b = rng.choice([a[:at] + "".join(rng.choice("xyz") for _ in range(rng.randint(0, 80))) + a[at:], a[at:], "".join(
            rng.choice("abcdefgh ") for _ in range(300))])
        one, two = Counter(m for _, m in plain_syncmers(a)), Counter(m for _, m in plain_syncmers(b))
        both = sum((one & two).values())
        union = sum((one | two).values())
        got = syncmers.likeness(syncmers.sketch(a), syncmers.sketch(b))
        assert 0 <= got <= 1 and (not one or not two or got <= both / union + 1e-9)
        assert syncmers.likeness(syncmers.sketch(b), syncmers.sketch(a)) == got
