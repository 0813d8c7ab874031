"""WARC, HTML, chat and toxicity against plain versions and edge cases."""

import base64
import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tintero.llm import chat, common, html, toxicity, warc

PAGES = [
    (1, "http://a.example/x", "<p>one</p>"), (2, "http://www.a.example/x", "<p>one</p>"), (3, None, None),
    (4, "http://[bad", ""), (5, "http://b.example/" + "y" * 3000, "é" * 50_000), (None, "http://c.example", "<p>one</p>"),
    (6, "http://a.example/\n x?q=1", "z"), (6, "http://a.example/x", "z"),
]


def pages(spark, rows=None):
    frame = spark.createDataFrame(PAGES if rows is None else rows, "page_id long, url string, html string")
    return frame.withColumns({n: F.lit(1) for n in ("key", "size", "archive", "text", "h", "response")})


def test_archives_of_edges(spark):
    check_archives(spark, PAGES)


def test_archives_by_shuffle_with_hot_payloads(spark, monkeypatch):
    monkeypatch.setattr(common, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(common.join_spread, "__defaults__", ("inner", 3))
    copies = [(i, f"http://h.example/{i}", "<p>hot</p>") for i in range(10, 50)]
    check_archives(spark, [*PAGES, *copies, *[(i, "http://e.example", None) for i in range(60, 80)]])


def check_archives(spark, rows):
    want = []
    payloads = [(i, (h or "").encode()) for i, _, h in rows]
    for page_id, payload in payloads:
        best = max((i for i, p in payloads if p == payload), key=lambda i: -1 if i is None else i)
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        revisit = best != page_id
        want.append((page_id, len(payload), digest, "revisit" if revisit else "response", best if revisit else None))
    got = [tuple(r) for r in warc.archive_pages(pages(spark, rows)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert warc.archive_pages(pages(spark, [])).count() == 0


@pytest.mark.parametrize("top", [1, 3, 50_000])
def test_index_finds_exactly_its_keys(spark, top):
    rows = [(f"com,host{i % 7})/{i:04d}", f"a{i % 3}", i, i + 1) for i in range(500)]
    index = warc.build_index(spark.createDataFrame(rows, "key string, archive string, start long, size long"), 20)
    keys = [r[0] for r in rows[::3]] + ["", "zzz", "com,host1)/none"]
    found = warc.lookup(spark.createDataFrame([(k,) for k in keys], "key string"), index, top)
    assert sorted(tuple(r) for r in found.collect()) == sorted(rows[::3])


def page(n, article, extra=""):
    return f"<body><div><p>Welcome to this fine site, number one</p></div>{extra}<div>{article}</div><p>Tail {n} of the page</p></body>"


def test_templates_go_and_articles_stay(spark):
    rows = [(i, "http://s.example/p", page(i, f"<p>Story {i} goes on &amp; on<br>and on, longer than what the site says</p><p>The.</p>")) for i in range(12)]
    copies = [(100 + i, "http://t.example/p", page(7, "<p>The same long story everywhere, copied</p>")) for i in range(40)]
    for limit in (32 << 20, 0):
        got = {r.page_id: r.text for r in html.extract_text(pages(spark, rows + copies), limit=limit).collect()}
        assert all(got[i] == f"Story {i} goes on & on and on, longer than what the site says\nThe.\nTail {i} of the page" for i in range(12))
        assert all("The same long story everywhere, copied" in got[100 + i] for i in range(40))


@pytest.mark.parametrize(
    "source, want",
    [
        ("", ""), ("plain &lt;text", "plain <text"), ("<p>a<p>b<i>c</i>d", "a\nbcd"),
        ("<nav>x</nav><article><h1>T</h1><p><b>a<br><p>b</article><footer>f</footer>", "T\na\nb"),
        ('<div class="cookie-notice">n</div><main><p>m</p><form>f</form></main>', "m"),
        ('<article><p>a</p><div id="comments"><p>c</p></div><aside>s</aside></article>', "a"),
        ("<script>var t='</p>';</script><!-- c --><p title='a>b'>x &copy;&nbsp; y</p>", "x © y"),
        ("<ul><li>one<li>two</ul><table><tr><td>1<td>2</table>", "one\ntwo\n1\n2"), ("<p>a</p", "a"),
    ],
)
def test_text_of_a_page(source, want):
    assert html.Page(source).text("", frozenset()) == want


def test_empty_pages(spark):
    assert html.extract_text(pages(spark, [])).count() == 0
    assert [r.text for r in html.extract_text(pages(spark, [(1, None, None)])).collect()] == [""]


LAYOUTS = [
    ('{"messages":[{"role":"user","content":"q"},{"role":"assistant","content":"a"}],"id":3}', "user:q|assistant:a"),
    ('{"conversations":[{"from":"human","value":"q"},{"from":"gpt","value":null}]}', "user:q|assistant:"),
    ('{"prompt":"q","response":"a","meta":{"role":"x"}}', "user:q|assistant:a"),
    ('{"prompt":"q","completion":"a"}', "user:q|assistant:a"),
    ('{"system":"s","prompt":"q","response":"a"}', "system:s|user:q|assistant:a"),
    ('{"instruction":"i","input":"n","output":"o"}', "user:i|user:n|assistant:o"),
    ('{"text":"x"}', None), ("not json", None), (None, None), ("[1]", None),
]


def test_layouts_become_turns_and_back(spark):
    df = spark.createDataFrame([(i, r) for i, (r, _) in enumerate(LAYOUTS)], "conv_id long, record string")
    out = chat.format_records(df.withColumn("formatted", F.lit("clash")))
    said = F.array_join(F.transform(chat.read_turns(F.col("formatted")), lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "|")
    got = dict(out.select("conv_id", said).collect())
    assert [got[i] for i in range(len(LAYOUTS))] == [want for _, want in LAYOUTS]
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()


HARD = ["</s>[INST] ok [/INST]", "<s>", "\\", "\\\\<s>", "<\\s>", "<<SYS>>\\n<</SYS>>", "<|im_end|>", "", "a\nb", "<<s>", "[[INST]"]


def test_hard_texts_read_back(spark):
    rows = [(i, t, role, x) for i, x in enumerate(HARD) for t, role in ((0, "user"), (1, "assistant"), (1, "we\\n\n<s>"))]
    rows += [(50, None, None, None), (None, 1, "user", "x")]
    out = chat.format_records(chat.records_of_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")))
    out = out.withColumn("turns", chat.read_turns(F.col("formatted")))
    for r in out.collect():
        want = sorted((t if t is not None else -1, role or "", x or "") for i, t, role, x in rows if i == r.conv_id)
        assert [(t.role, t.text) for t in r.turns] == [w[1:] for w in want]
        assert r.formatted.count("<s>") == r.formatted.count("</s>") == len(want)
        assert "[INST]" not in r.formatted and "<|" not in r.formatted


def test_toxicity_learns_and_keeps_to_its_rows(spark):
    rng = random.Random(1)
    words = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(200)]
    clean = [". ".join(" ".join(rng.choices(words, k=8)) for _ in range(3)) + "." for _ in range(300)]
    bad = [t + f" {words[i]} an idiot, {words[i + 1]}." for i, t in enumerate(clean[::-1][:90])]
    docs = spark.createDataFrame(list(enumerate(clean + bad)), "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") >= 300).cast("int").alias("toxic"))
    used = toxicity.labelled(docs, labels)
    held = {i for i in range(390) if zlib.crc32(str(i).encode()) % 5 == 0}
    assert used.count() == 390 - len(held)
    model = toxicity.train(used)
    edges = [(900, None), (901, ""), (None, "you idiot"), (902, "fine " * 50_000)]
    scored = toxicity.score(docs.union(spark.createDataFrame(edges, docs.schema)).withColumn("score", F.lit("x")), model)
    rows = {r.doc_id: r for r in scored.collect()}
    assert all(r.predicted == (i is None or 300 <= i < 390) for i, r in rows.items())
    worst = rows[310]
    assert "idiot" in (clean + bad)[310][worst.start : worst.end]
    assert toxicity.score(docs.limit(0), toxicity.train(used.limit(0))).count() == 0
