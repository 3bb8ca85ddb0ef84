import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
from genoframe.llm import fingerprints as fp


def jaccard(a, b):
    x, y = Counter((a or "").lower().split()), Counter((b or "").lower().split())
    top = sum((x | y).values())
    return sum((x & y).values()) / top if top else 1.0


def test_collisions_estimate_generalised_jaccard():
    rng = np.random.default_rng(1)
    vocab = np.array([f"w{i}" for i in range(60)])
    texts = [" ".join(rng.choice(vocab, 150, p=rng.dirichlet(np.full(60, 0.4)))) for _ in range(40)]
    texts += [t + " " + texts[0] for t in texts[:10]]
    sig = fp.fingerprint_column(pa.array(texts), samples=2048)
    errors = [fp.likeness(sig[i : i + 1], sig[j : j + 1])[0] - jaccard(texts[i], texts[j]) for i in range(50) for j in range(i)]
    assert np.abs(errors).max() < 0.06 and abs(np.mean(errors)) < 0.01


def test_equal_texts_and_chunks():
    texts = ["a b b c", "", None, "x " * 3000, "a b b c"]
    one, many = fp.fingerprint_column(pa.array(texts)), fp.fingerprint_column(pa.array(texts), limit=1)
    assert (one == many).all() and (one[0] == one[4]).all() and not one[1].any() and not one[2].any()


def brute(rows):
    rows = sorted({r for r in rows if r[0] is not None}, key=lambda r: (r[0], r[1] or ""))
    ids = sorted({i for i, _ in rows})
    first = {i: next(t for j, t in rows if j == i) or "" for i in ids}
    out = {}
    for i, text in rows:
        text, after = text or "", first[ids[(ids.index(i) + 1) % len(ids)]]
        cut = len(text) // 4
        edited = text[: len(text) - cut] + after[:cut]
        a, b, c = (fp.fingerprint_column(pa.array([t])) for t in (text, edited, after))
        out[i, text] = len(text), hashlib.sha256(edited.encode()).hexdigest(), fp.likeness(a, b)[0], fp.likeness(a, c)[0]
    return out


def test_edit_probe_equals_brute_force(table, corpus, odd, empty):
    want = brute(corpus)
    got = fp.edit_probe(table(corpus)).collect()
    texts = dict(corpus)
    assert {(r.doc_id, texts[r.doc_id] or ""): (r.n_chars, r.edited_sha256, r.near_edited, r.near_next) for r in got} == want and len(got) == len(corpus)
    assert all(len(r.fingerprint) == 4 * fp.SAMPLES for r in got)
    want = brute([(r.doc_id, r.text) for r in odd.collect()])
    got = fp.edit_probe(odd).collect()
    assert len(got) == 5 and {(r.n_chars, r.edited_sha256, r.near_edited, r.near_next) for r in got} == set(want.values())
    assert fp.edit_probe(empty).count() == 0 and fp.fingerprints(empty).count() == 0 and fp.fingerprints(odd).count() == 6
    assert fp.edit_probe(table([(7, "just one text")])).first().near_next == 1.0


def test_samples_equal_draws_written_out_in_plain_floats():
    import math

    from genoframe.llm.text import SPACED_LOWER, Words, chunks

    mask = (1 << 64) - 1

    def mix(x):
        x ^= x >> 30
        x = x * 0xBF58476D1CE4E5B9 & mask
        x ^= x >> 27
        x = x * 0x94D049BB133111EB & mask
        return x ^ x >> 31

    def unit(bits, width):
        return (bits + 0.5) / 2**width

    def sample(weights, k):
        """The (term, level) of least c / (y e^r), ln y = r (level - b), of terms with their weights."""
        best = None
        for term, w in weights.items():
            x = mix(term + k * 0x9E3779B97F4A7C15 & mask)
            r = -math.log(unit(x >> 40, 24) * unit(x >> 16 & 0xFFFFFF, 24))
            b = unit(x & 0xFFFF, 16)
            y = mix(x + 0xC2B2AE3D27D4EB4F & mask)
            c = -math.log(unit(y >> 40, 24) * unit(y >> 16 & 0xFFFFFF, 24))
            level = math.floor(math.log(w) / r + b)
            a = math.log(c) - r * (level - b) - r
            best = min(best or (math.inf,), (a, term, level))
        return best[1:]

    texts = ["a b b c d d d e " * 3 + "f g", "a b c c c d d e " * 2 + "h f", "x y z x"]
    plain = []
    for t in texts:
        ((_, _, data, offsets),) = chunks(pa.array([t]))
        weights = Counter(Words(data, offsets, SPACED_LOWER).hash.tolist())
        plain.append([sample(weights, k) for k in range(1, 257)])
    sig = fp.fingerprint_column(pa.array(texts), samples=256)
    for i, j in ((0, 1), (0, 2), (1, 2)):
        same = np.array([x == y for x, y in zip(plain[i], plain[j], strict=True)])
        assert ((sig[i] == sig[j]) == same).mean() > 0.99


def test_no_literal_grows_with_blocks(table):
    few, many = (fp.with_next(table([(i, "x") for i in range(500)]), blocks=n)._jdf.queryExecution().analyzed().toString() for n in (2, 200))
    assert abs(len(few) - len(many)) < 40
