"""Source divergence and filter interactions against plain versions."""

import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tintero.llm import divergence, filters

COLUMNS = "doc_id long, text string, lang string, source string"


def ranked(values):
    order = sorted(values.items(), key=lambda kv: (-kv[1], kv[0].encode()))
    return [(item, value, i) for i, (item, value) in enumerate(order, 1)]


def plain_divergence(docs, min_docs, top):
    counts, in_docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source in docs:
        lang, source = lang or "", source or ""
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low)
        groups.add((lang, source))
        counts[lang, source].update(terms)
        in_docs[lang].update(set(terms))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in in_docs[lang].items() if n >= min_docs]
        of_lang = Counter()
        for group in groups:
            if group[0] == lang:
                of_lang.update(counts[group])

        def shares(c):
            total = sum(c[t] for t in kept) + 5 * len(kept)
            return {t: 1 + 10**9 * (c[t] + 5) // total for t in kept}

        p, q = {s: shares(counts[lang, s]) for g, s in groups if g == lang}, shares(of_lang)
        for s in p:
            pairs = {o: sum(abs(p[s][t] - p[o][t]) for t in kept) for o in p if o != s}
            terms = {t: p[s][t] - q[t] for t in kept if counts[lang, s][t] and p[s][t] > q[t]}
            out += [(lang, s, "pair", *r) for r in ranked(pairs)]
            out += [(lang, s, "term", *r) for r in ranked(terms) if r[2] <= top]
    return sorted(out)


def random_docs(rng, n):
    words = ["Apple", "pear", "naïve", "größe", "x1y", "don't", "ÉCOLE", " ", "日本"] + [f"w{chr(97 + i)}" for i in range(20)]
    docs = [
        (i, " ".join(rng.choice(words[: rng.randint(1, len(words))]) for _ in range(rng.randint(0, 30))), rng.choice(["en", "de"]), f"s{rng.randint(0, 4)}")
        for i in range(n)
    ]
    return docs + [
        (n, None, None, None), (None, "apple pear", "en", None), (n, "", "xx", "only"), (n, "", "xx", "empty"),
        (n + 1, "Apple " * 5000, "de", "s1"), (n + 1, "Apple " * 5000, "de", "s1"),
    ]


@pytest.mark.parametrize("cells", [1 << 4, 1 << 21])
def test_divergence(spark, cells):
    docs = random_docs(random.Random(cells), 300)
    frame = spark.createDataFrame(docs, COLUMNS).selectExpr("*", "1 as n", "2 as slot", "'x' as term", "3 as segment")
    found = divergence.source_divergence(frame, min_docs=5, top=4, cells=cells)
    got = found.select("lang", "source", "part", "item", "value", "rank").collect()
    assert sorted(tuple(r) for r in got) == plain_divergence(docs, 5, 4)


def test_divergence_of_nothing(spark):
    none = spark.createDataFrame([], COLUMNS)
    assert divergence.source_divergence(none).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), min_size=8, max_size=8), min_size=2, max_size=4), st.integers(1, 50))
def test_walk_prices_what_leaf_by_leaf_comparison_does(counts, extra):
    counts = np.array(counts)
    forest = divergence.Forest(counts)
    totals = [int(c.sum()) + 40 + extra for c in counts]
    shares = [divergence._shares(forest, t) for t in totals]
    for i in range(len(counts)):
        for j in range(len(counts)):
            x, y, steps = forest.walk(forest.roots[i], forest.roots[j], totals[i] == totals[j])
            value = forest.price(np.abs(shares[i][x] - shares[j][y]), steps)
            own = [abs(divergence.share(a, totals[i]) - divergence.share(b, totals[j])) for a, b in zip(counts[i], counts[j])]
            assert value == sum(own)


def test_equal_subtrees_are_one_node_and_one_price():
    block = [3, 0, 1, 0]
    forest = divergence.Forest(np.array([block * 64, [0, 1, 0, 2] * 64]))
    assert [len(left) for left, _ in forest.levels] == [4] + [2] * 7
    x, _, steps = forest.walk(*forest.roots, False)
    assert len(x) == 4 and max(len(s) for s in steps) == 4


def test_terms_of_a_long_text_are_cut_between_terms(monkeypatch):
    text = ("Ab cd," * 500 + "ÀÉ" * 300).encode()
    whole = [t for part in divergence._terms(text) for t in part]
    monkeypatch.setattr(divergence, "_SLICE", 17)
    assert [t for part in divergence._terms(text) for t in part] == whole


# ------------------------------------------------------------------ filters


def plain_interactions(docs, labels):
    least, marks = {}, defaultdict(lambda: [False, False])
    for doc_id, text, _ in docs:
        if doc_id is not None:
            least[text or ""] = min(doc_id, least.get(text or "", doc_id))
    for doc_id, quality, toxic in labels:
        marks[doc_id][0] |= quality == 1
        marks[doc_id][1] |= toxic == 1
    rows = []
    for doc_id, text, lang in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(words) < 100,
            "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)),
            "E": doc_id is not None and doc_id > least[text],
        }
        rows.append((lang or "", fails, *(marks[doc_id] if doc_id is not None else (False, False))))
    out = []
    for part in {r[0] for r in rows}:
        mine, whole = [r for r in rows if r[0] == part], Counter()
        steps = []
        for order in permutations("ABCDE"):
            for i, letter in enumerate(order):
                before = order[:i]
                open_rows = [r for r in mine if not any(r[1][b] for b in before)]
                removed = [r for r in open_rows if r[1][letter]]
                failing = [r for r in mine if r[1][letter]]
                unique = [r for r in failing if sum(r[1].values()) == 1]
                whole[letter] += len(removed)
                steps.append((letter, (
                    part, "".join(order), i + 1, len(open_rows) - len(removed), len(removed), len(failing) - len(removed),
                    len(unique), sum(r[2] for r in removed), sum(r[3] for r in removed),
                )))
        out += [(*row, whole[letter]) for letter, row in steps]
    return sorted(out)


def written(spark, folder, docs, files):
    """The rows in several files, whose names put the largest ids first."""
    path = str(folder / "documents.parquet")
    size = -(-len(docs) // files)
    for start in range(0, len(docs), size):
        part = spark.createDataFrame(docs[start : start + size], "doc_id long, text string, lang string")
        part.selectExpr("*", "'x' as part", "1 as mask", "2 as n", "true as good", "'k' as key").coalesce(1).write.mode("append").parquet(path)
    return path


def audit_docs(rng):
    texts = [" ".join(rng.choice(["a", "bb", "CC", "d#", "é", f"u{i}"]) + str(rng.randint(0, 40) * (i % 3)) for i in range(rng.randint(0, 130))) for _ in range(25)]
    texts += [" ".join(f"w{j}{i}" for j in range(120)) for i in range(5)] + ["SHOUT", None, "", "x" * 300_000]
    docs = [(200 - i, rng.choice(texts), rng.choice(["en", "de", None])) for i in range(120)]
    docs += [(None, "SHOUT", "en"), (None, "SHOUT", "en"), (7, "SHOUT", "en"), (7, "SHOUT", "de"), (7, "SHOUT", "en"), (7, "other", "en")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(60, 200, 2)] + [(80, 1, 0), (80, 0, 1), (None, 1, 1)]
    return docs, labels


@pytest.mark.parametrize("files, batches", [(1, 1), (6, 6), (6, 2)])
def test_interactions(spark, tmp_path, files, batches):
    docs, labels = audit_docs(random.Random(files * 10 + batches))
    path = written(spark, tmp_path, docs, files)
    marked = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = filters.filter_interactions(spark, path, marked, batches)
    names = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    got = sorted(tuple(r) for r in found.select(names).collect())
    assert got == plain_interactions(docs, labels)
    assert len(got) == 600 * len({d[2] or "" for d in docs})


def test_interactions_of_nothing(spark, tmp_path):
    path = written(spark, tmp_path, [(1, "a", "en")], 1)
    empty = str(tmp_path / "empty.parquet")
    spark.read.parquet(path).where("false").write.parquet(empty)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filters.filter_interactions(spark, empty, labels).collect() == []


class _State:
    exists, value = False, None

    @property
    def get(self):
        return self.value

    def update(self, value):
        self.exists, self.value = True, value


def test_a_smaller_id_retracts_what_was_entered_before():
    state, columns = _State(), ["key", "id", "part", "mask", "good", "toxic", "n"]

    def arrive(*rows):
        frame = filters.pd.DataFrame([(b"text", *r) for r in rows] + [(b"other", 5, "en", 0, False, False, 1)], columns=columns)
        return [tuple(r) for f in filters._retract((3,), [frame], state) for r in f.itertuples(index=False)]

    assert arrive((9, "en", 2, True, False, 1)) == []
    assert arrive((12, "de", 2, False, False, 1)) == [("de", 2, False, False, -1), ("de", 18, False, False, 1)]
    assert arrive((4, "fr", 2, False, True, 1)) == [("en", 2, True, False, -1), ("en", 18, True, False, 1)]
    assert arrive((4, "fr", 2, False, True, 1)) == []
    assert arrive((1, "es", 2, False, False, 1)) == [("fr", 2, False, True, -2), ("fr", 18, False, True, 2)]
