"""The two learned models next to plain versions of their own: one number after another, no shared code."""

import math
import random
from collections import Counter

import numpy as np
from tables import table  # noqa: F401

from quadrat.llm import langid, quality


def texts(n, seed):
    rng = random.Random(seed)
    words = {"x": ["the", "cat", "and", "Dog", "sat"], "y": ["der", "hund", "und", "größe", "nicht"], "z": ["el", "perro", "niño", "y", "casa"]}
    return [(i, " ".join(rng.choice(words[lang]) for _ in range(rng.randint(3, 60))), lang) for i in range(n) for lang in [rng.choice("xyz")]]


# --- language ---


def plain_counts(text):
    low = "".join(c if "a" <= c <= "z" or ord(c) >= 128 else " " for c in text.lower())
    raw = (" " + " ".join(p for p in low.split(" ") if p) + " ").encode()
    return Counter((((raw[i] << 16 | raw[i + 1] << 8 | raw[i + 2]) * 2654435761) & 0xFFFFFFFF) >> 19 for i in range(len(raw) - 2))


def plain_unit(tf, idf):
    v = {b: math.log1p(n) * idf[b] for b, n in tf.items()}
    size = math.sqrt(sum(x * x for x in v.values())) or 1
    return {b: x / size for b, x in v.items()}


def dot(a, b):
    return sum(x * b.get(k, 0.0) for k, x in a.items())


def mean(vectors):
    out = Counter()
    for v in vectors:
        for k, x in v.items():
            out[k] += x / len(vectors)
    return dict(out)


def plain_clusters(vectors):
    centre = mean(vectors)
    chosen = [max(range(len(vectors)), key=lambda i: dot(vectors[i], centre))]
    while len(chosen) < min(langid.CLUSTERS, len(vectors)):
        chosen.append(min(range(len(vectors)), key=lambda i: max(dot(vectors[i], vectors[j]) for j in chosen)))
    centres = [vectors[i] for i in chosen]
    for _ in range(langid.ROUNDS):
        own = [max(range(len(centres)), key=lambda c: (dot(v, centres[c]), -c)) for v in vectors]
        moved = []
        for c in range(len(centres)):
            m = mean([v for v, o in zip(vectors, own) if o == c]) if c in own else centres[c]
            size = math.sqrt(dot(m, m))
            moved.append({k: x / size for k, x in m.items()})
        centres = moved
    return centres


def test_language_model_next_to_a_plain_one(table):
    rows = texts(90, 3)
    model = langid.fit(table("doc_id bigint, text string, lang string", rows))
    tfs = [(lang, plain_counts(t)) for _, t, lang in rows]
    seen = Counter(b for _, tf in tfs for b in tf)
    idf = {b: math.log((1 + len(rows)) / (1 + n)) + 1 for b, n in seen.items()}
    assert all(abs(model.idf[b] - x) < 1e-5 for b, x in idf.items())
    idf = Counter(idf)
    for b in range(len(model.idf)):
        idf.setdefault(b, math.log(1 + len(rows)) + 1)
    centres = []
    for lang in "xyz":
        ordered = sorted((tf for own, tf in tfs if own == lang), key=lambda tf: np.array([tf.get(b, 0) for b in range(len(model.idf))], np.float32).tobytes())
        centres += [(lang, c) for c in plain_clusters([plain_unit(tf, idf) for tf in ordered])]
    new = [t for _, t, _ in texts(40, 9)]
    for text, (lang, score, _) in zip(new, model.predict(new)):
        v = plain_unit(plain_counts(text), idf)
        best = max(centres, key=lambda c: dot(v, c[1]))
        assert lang == best[0] and abs(score - dot(v, best[1])) < 1e-4


# --- quality ---


def plain_features(text):
    raw = text.encode()
    kind = lambda c: "a" if 97 <= c <= 122 else "A" if 65 <= c <= 90 else "0" if 48 <= c <= 57 else "x" if c >= 128 else chr(c)
    shape = "\n" + "".join(map(kind, raw)) + "\n"
    n = max(len(raw), 1)
    grams = Counter(((ord(a) << 16 | ord(b) << 8 | ord(c)) * 2654435761 & 0xFFFFFFFF) >> 24 for a, b, c in zip(shape, shape[1:], shape[2:]))
    words, lines = raw.split(), [x for x in raw.split(b"\n") if x.strip()]
    w, k = max(len(words), 1), max(len(lines), 1)
    share = {c: shape.count(c) / n for c in "Aa0x \n"}
    extra = [
        math.log1p(len(words)), math.log1p(len(lines)), share["A"], share["a"], share["0"], share["x"], share[" "], 1 - sum(share.values()),
        min(len(raw) / w, 30) / 10, len(set(words)) / w, len(set(lines)) / k, min(w / k, 200) / 50, sum(x.isupper() for x in words) / w,
        sum(x.isascii() and not x.isalpha() for x in words) / w, 0.0 if words else 1.0, sum(words[i] == words[i + 1] for i in range(len(words) - 1)) / w]
    return [math.sqrt(grams[b] / n) for b in range(256)] + extra


def test_quality_features_next_to_plain_ones():
    for text in ["", "Two words.\nTwo words.\n\n", "AB 12 é *** the the", "\n", *(t for _, t, _ in texts(20, 1))]:
        assert np.allclose(quality.features(text), plain_features(text), atol=1e-6)


def risk(w, p, u, prior):
    """Non-negative risk of a batch: positives as positive, and what is left of the unlabelled as negative."""
    f = lambda x: sum(a * b for a, b in zip(w, x)) + w[-1]
    loss = lambda z: math.log1p(math.exp(-abs(z))) + max(-z, 0.0)  # noqa: E731 (of a text taken as positive)
    positive = prior * sum(loss(f(x)) for x in p) / len(p)
    negative = sum(loss(-f(x)) for x in u) / len(u) - prior * sum(loss(-f(x)) for x in p) / len(p)
    return positive, negative


def test_steps_follow_the_slope_of_the_risk():
    """The weights after some steps, with slopes taken from differences of the risk."""
    rng = np.random.default_rng(5)
    positive, unlabelled = rng.normal(0.5, 1, (12, 3)), np.concatenate([rng.normal(0.5, 1, (8, 3)), rng.normal(-1, 1, (9, 3))])
    for prior in (0.3, 0.9):
        for steps in (1, 3):
            draw, w, first, second = np.random.default_rng(0), [0.0] * 4, [0.0] * 4, [0.0] * 4
            for t in range(1, steps + 1):
                p, u = positive[draw.integers(0, 12, quality.BATCH)].tolist(), unlabelled[draw.integers(0, 17, quality.BATCH)].tolist()
                keeps = risk(w, p, u, prior)[1] >= 0
                total = lambda v: sum(risk(v, p, u, prior)) if keeps else -risk(v, p, u, prior)[1]  # noqa: E731, B023
                slope = []
                for i in range(4):
                    up, down = list(w), list(w)
                    up[i] += 1e-5
                    down[i] -= 1e-5
                    slope.append((total(up) - total(down)) / 2e-5 + (5 / 12 * w[i] if i < 3 else 0))
                for i in range(4):
                    first[i] = 0.9 * first[i] + 0.1 * slope[i]
                    second[i] = 0.999 * second[i] + 0.001 * slope[i] ** 2
                    w[i] -= 0.02 * (1 - 0.9 * t / steps) * (first[i] / (1 - 0.9 ** t)) / (math.sqrt(second[i] / (1 - 0.999 ** t)) + 1e-8)
            assert np.allclose(quality._descend(positive, unlabelled, prior, steps), w, atol=1e-5)


def test_scores_are_the_logistic_of_the_weights(table):
    rows = [(i, t if i % 3 else "*** 1 2 ##", 0) for i, t, _ in texts(60, 4)]
    df = table("doc_id bigint, text string, other int", rows)
    model = quality.fit(df, df.filter("doc_id % 3 <> 0 and doc_id < 40").select("doc_id"))
    for r in quality.score(df, model).collect():
        x = [min(max((a - m) / s, -8), 8) for a, m, s in zip(plain_features(r["text"]), model.mean, model.spread)]
        z = sum(a * b for a, b in zip(x, model.weights)) + model.weights[-1]
        assert abs(r["score"] - 1 / (1 + math.exp(-z))) < 1e-4 and r["predicted"] == int(r["score"] >= 0.3)
