"""The language-model operators against plain versions, exact round trips and held-out grades."""

import base64
import random
from collections import defaultdict

import numpy as np
import pytest
import tiktoken
from tokenizers import Tokenizer

from tidemark.llm import encode, mail, mix, nearest, reading, vocab

PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@pytest.fixture(scope="module")
def enc():
    return vocab.encoder(encode.VOCABULARY)


@pytest.fixture(scope="module")
def plain(enc):
    return tiktoken.Encoding("plain", pat_str=PATTERN, mergeable_ranks=enc.ranks, special_tokens={})


HARD = ["", None, "'s", "it's 'll  'll\n\n x'sfoo''s 've'd  ", "   ", " \n a", "a\n\n\nb", "a  b", "'l", "'la 'r're", "x 's", "\0a\0\0", "<|endoftext|>", "a'" + "b" * 300, "é" * 100 + "日本" * 90 + "'ll", "1'2's", "'''s", "'’s", " 　x   y", "🙂🙂 🙂"]


def ids_of(enc, texts):
    flat, at = enc.encode(texts)
    return [flat[at[i] : at[i + 1]].tolist() for i in range(len(texts))]


def test_ids_equal_the_regular_expression(enc, plain):
    rng = random.Random(3)
    alphabet = "''  \n\tslvredmtax1²é日!.-　\0Ⅷ"
    texts = HARD + ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(3_000)]
    assert ids_of(enc, texts) == [plain.encode_ordinary(t or "") for t in texts]


def test_ids_equal_the_other_library(enc):
    t = Tokenizer.from_file(f"{vocab.VOCABULARIES}/byte_bpe_50k.json")
    t.encode_special_tokens = True
    texts = [x for x in HARD if x]
    assert ids_of(enc, texts) == [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


def test_scan_is_associative():
    rng = np.random.default_rng(0)
    gen, product, _, _ = vocab.automaton()
    for n in (1, 255, 256, 257, 70_000):
        x = gen[rng.integers(0, 12, n)]
        got, acc = vocab.scan(x), 0
        for i, e in enumerate(x.tolist()):
            acc = int(product[acc, e])
            if i % 97 == 0 or i == n - 1:
                assert got[i] == acc


def test_long_pieces_and_texts(enc, plain, monkeypatch):
    rng = random.Random(1)
    piece = "".join(rng.choice("abcdefgh") for _ in range(20_000))
    text = " ".join(["word", "x1", piece[:700]] * 60)
    assert ids_of(enc, [piece]) == [plain.encode_ordinary(piece)]
    monkeypatch.setattr(vocab, "SLICE", 5_000)
    assert len(vocab.parts_of(text)) > 3
    assert ids_of(enc, [text, "tail", piece]) == [plain.encode_ordinary(x) for x in (text, "tail", piece)]


def test_encoding_tables(spark):
    rows = [(i, t, "clash", [1], 5) for i, t in enumerate([*HARD, "a " * 50_000])]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, ids string, ends array<int>, tokens int")
    got = encode.encode(df, ["doc_id"], offsets=True)
    assert got.columns == ["doc_id", "ids", "ends"]
    found = {r.doc_id: r for r in got.collect()}
    assert found[0].ids == [] and found[1].ids == []
    for i, t, *_ in rows:
        ends = found[i].ends
        assert (ends[-1] if ends else 0) == len((t or "").encode()) and len(ends) == len(found[i].ids)
    back = {r.doc_id: r.text for r in encode.decode(got, ["doc_id"]).collect()}
    assert all(back[i] == (t or "") for i, t, *_ in rows)
    assert {r.doc_id: r.tokens for r in encode.count(df, ["doc_id"]).collect()} == {i: len(found[i].ids) for i in found}
    assert not encode.encode(df.limit(0), ["doc_id"]).count()


@pytest.mark.parametrize("seed", range(3))
def test_nearest(spark, seed):
    rng = random.Random(seed)
    pick = lambda n: rng.choice([None, *[rng.randint(0, n) for _ in range(12)]])
    left = [(rng.choice(["A", "A", "B", None]), pick(30_000), 1) for _ in range(300)]
    right = [(rng.choice(["A", "A", "B", None]), pick(30_000), rng.choice([None, rng.randint(1, 9)])) for _ in range(60)] + [("A", 7_000, k) for k in (3, None, 8)]
    got = nearest.nearest(spark.createDataFrame(left, "y string, t bigint, u int"), spark.createDataFrame(right, "y string, r bigint, u bigint"), ["y"], "t", "r", "u", 2_000)
    best = defaultdict(lambda: None)
    for y, r, u in right:
        if y is not None and r is not None:
            best[y, r] = max((x for x in (best[y, r], u) if x is not None), default=None)
    want = []
    for y, t in {(y, t) for y, t, _ in left if y is not None and t is not None}:
        near = sorted((abs(r - t), r) for (z, r) in best if z == y and abs(r - t) <= 2_000)
        if near:
            want.append((y, t, near[0][1], best[y, near[0][1]]))
    assert sorted(map(tuple, got.collect())) == sorted(want, key=lambda x: x[:3])


def test_nearest_where_times_are_dense(spark):
    """A tolerance of hours over times a millisecond apart: rounds follow the density, the first one looks at few rows."""
    left = spark.range(0, 4_000_000, 40_009).selectExpr("'A' y", "id + 1 t")
    right = spark.range(0, 60_000).selectExpr("'A' y", "id * 7 r", "id u").union(spark.createDataFrame([("A", 3_900_000, 7)], "y string, r bigint, u bigint"))
    got = {r.t: r.r for r in nearest.nearest(left, right, ["y"], "t", "r", "u", 3_600_000).collect()}
    times = np.array([*range(0, 420_000, 7), 3_900_000])
    want = {}
    for t in range(1, 4_000_001, 40_009):
        d = np.abs(times - t)
        if d.min() <= 3_600_000:
            want[t] = int(times[d.argmin()])
    assert got == want


def test_nearest_without_rows(spark):
    none = spark.createDataFrame([], "y string, t bigint")
    assert not nearest.nearest(none, spark.createDataFrame([("A", 1, 1)], "y string, r bigint, u bigint"), ["y"], "t", "r", "u", 50).count()
    assert not nearest.nearest(spark.createDataFrame([("A", 1)], "y string, t bigint"), spark.createDataFrame([], "y string, r bigint, u bigint"), ["y"], "t", "r", "u", 50).count()


@pytest.mark.parametrize("seed", range(20))
def test_budget_fits_as_well_as_can_be(seed):
    rng = random.Random(seed)
    counts = {rng.randint(1, 40): rng.randint(1, 3) for _ in range(5)}
    total = sum(n * k for n, k in counts.items())
    budget = rng.randint(0, total + 5)
    took = mix.fit(counts, budget)
    assert all(0 < k <= counts[n] for n, k in took.items())
    got = sum(n * k for n, k in took.items())
    sums = {0}
    for n, k in counts.items():
        sums = {s + n * j for s in sums for j in range(k + 1)}
    assert got == max(s for s in sums if s <= budget)


def test_large_budget_is_met_exactly():
    rng = random.Random(0)
    counts = {n: rng.randint(1, 2_000) for n in rng.sample(range(5, 9_000), 3_000)}
    budget = sum(n * k for n, k in counts.items()) * 37 // 100 + 1
    assert sum(n * k for n, k in mix.fit(counts, budget).items()) == budget


def test_document_longer_than_the_fitted_rest_is_taken():
    assert mix.fit({1_200_000: 1, 1_190_000: 1}, 1_250_000) == {1_200_000: 1}
    assert mix.fit({1_300_000: 1, 1_190_000: 1}, 1_250_000) == {1_190_000: 1}
    assert mix.fit({1_300_000: 2}, 1_250_000) == {}


def test_lengths_of_any_size_are_fitted_exactly():
    spent = lambda took: sum(n * k for n, k in took.items())
    assert mix.fit({900_000: 1, 800_000: 1, 700_000: 1}, 1_500_000) == {800_000: 1, 700_000: 1}
    assert spent(mix.fit({300_000: 1, 299_999: 1, 150_000: 1}, 300_000)) == 300_000
    assert mix.fit({2_000_000: 1, 1_999_999: 1}, 2_000_000) == {2_000_000: 1}
    rng = random.Random(7)
    for case in range(80):
        top = rng.choice([40, 3 * mix.EXACT, 20 * mix.EXACT])
        counts = {rng.randint(1, top): rng.randint(1, 3) for _ in range(rng.randint(1, 6))}
        sums = {0}
        for n, k in counts.items():
            sums = {s + n * j for s in sums for j in range(k + 1)}
        budget = rng.choice([rng.choice(sorted(sums)), rng.randint(0, max(sums))])
        took = mix.fit(counts, budget)
        assert spent(took) == max(s for s in sums if s <= budget) and all(k <= counts[n] for n, k in took.items()), (counts, budget)


def test_mixture(spark):
    rng = random.Random(2)
    docs = [(i, rng.choice(["web", " WEB", "News", "hot", "hot", "hot", "other", None]), rng.choice([None, "", "word " * rng.randint(1, 60)]), 9) for i in range(900)]
    df = spark.createDataFrame(docs, "doc_id bigint, source string, text string, copies int")
    targets = spark.createDataFrame([("web", 0.5, 1), ("news ", 0.4, 3), ("hot", 0.3, 1), ("absent", 0.2, 4), ("never", 0.1, 0), (None, 0.3, 2), ("x", None, 1)], "source string, target_share double, max_repeats int")
    got, report = mix.mixture(df, targets)
    rows = got.collect()
    caps = {"web": 1, "news": 3, "hot": 1}
    assert len({r.doc_id for r in rows}) == len(rows)
    assert all(1 <= r.copies <= caps[r.source] and r.tokens > 0 for r in rows)
    total = sum(r.tokens * r.copies for r in rows)
    for r in report.collect():
        used = sum(x.tokens * x.copies for x in rows if x.source == r.source)
        assert used == r.mix_tokens
        if r.source in caps:
            want = {"web": 0.5, "news": 0.4, "hot": 0.3}[r.source] / 1.2
            assert abs(used / total - want) < 0.002 and abs(r.actual_share - used / total) < 1e-9
    again = mix.mixture(df, targets)[0]
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, rows))
    assert not mix.mixture(df.limit(0), targets)[0].count()


MAIL = "From: A <a@b.example>\nSubject: Long words elsewhere\nContent-Type: text/plain\n\n"


@pytest.mark.parametrize(
    ("raw", "own"),
    [
        (None, ""), ("", ""), (" \n ", ""), ("only text", "only text"),
        (MAIL + "Hello Bo,\n\nWe sat.\n\nOn Mon, 1 Jan 2029, Bo wrote:\n> Hi\n> there\n\nIt ran.\n\nKind regards,\nA\n--\nA\n", "We sat.\n\nIt ran."),
        (MAIL.replace("\n", "\r\n") + "One.\r\nTwo.\r\n", "One.\nTwo."),
        (MAIL + "-----Original Message-----\nFrom: B\nSubject: x\n\nQuoted words.\n\n\nOwn words.\n\nThanks,\nA", "Own words."),
        (MAIL + "Own.\n\nThanks,\nA\n\n-----Original Message-----\nFrom: B\n\nQuoted.", "Own."),
        ("Content-Type: text/plain; charset=utf-8\nContent-Transfer-Encoding: base64\n\n" + base64.b64encode("Él comió.".encode()).decode(), "Él comió."),
        ("Content-Type: text/plain\nContent-Transfer-Encoding: quoted-printable\n\nEl ni=C3=B1o=\n com=C3=ADa.", "El niño comía."),
        ("Content-Type: text/plain\n\nEl niÃ±o.", "El niño."),
        ("Content-Type: text/html\n\n<html><head><style>p{x}</style></head><body><p>One &amp; two.</p><p>&gt; quoted</p></body></html>", "One & two."),
        ('Content-Type: multipart/mixed; boundary="b"\n\n--b\nContent-Type: text/plain\n\nMine.\n--b\nContent-Type: application/octet-stream; name="x.pdf"\nContent-Disposition: attachment; filename="x.pdf"\nContent-Transfer-Encoding: base64\n\nAAAA\n--b--', "Mine."),
        ("Auto-Submitted: auto-replied\n" + MAIL + "I am away.", ""), ("Auto-Submitted: no\n" + MAIL + "I am here.", "I am here."),
        ("Precedence: bulk\n" + MAIL + "Buy.", ""), ("Return-Path: <>\n" + MAIL + "Not delivered.", ""), ('Content-Type: multipart/report; boundary="b"\n\n--b\n\nNot delivered.\n--b--', ""),
        (MAIL + "This is an automatic reply. I am away.\nRef 5", ""),
        (MAIL + "Short.\n\n****************************************\nCONFIDENTIALITY NOTICE: whatever it says here.", "Short."),
        # what looks like a notice, a closing or a ruler but is prose
        (MAIL + "Thanks for the quick reply.\n\nWe sat on the bench by the river.\n\nRegards,\nBo", "Thanks for the quick reply.\n\nWe sat on the bench by the river."),
        (MAIL + "Thank you for your note.\nI will come.", "Thank you for your note.\nI will come."),
        (MAIL + "I was out of office when it rang.\n> out of office\nNow I am back.", "I was out of office when it rang.\nNow I am back."),
        (MAIL + "First part.\n----------------\nThe second part goes on.", "First part.\nThe second part goes on."),
        (MAIL + "The intended recipient was my aunt.\nShe sat by the fire and read it.", "The intended recipient was my aunt.\nShe sat by the fire and read it."),
        (MAIL + "One.\n\n-- \nBo Ek\nTel. +1 555", "One."),
    ],
)
def test_author(raw, own):
    common = mail.marks(["This is an automatic reply. I am away.", "CONFIDENTIALITY NOTICE: whatever it says here."])
    assert mail.author(raw, common) == own


def test_boilerplate_is_what_many_senders_write(spark):
    rng = random.Random(8)
    word = lambda n: " ".join(rng.choice("the big old dog cup hat road lamp saw took kept left by of".split()) for _ in range(n)) + f" {rng.random()}"
    foot = "Printed on paper that floats, read 17 times."
    texts = [(f"From: s{i % 40}@x.example\nSubject: x\n\n{word(9)}\nand so on.\n\n{foot.replace('17', str(i)) if i % 8 == 0 else word(6)}",) for i in range(400)]
    texts += [("From: one@x.example\n\nMy own words that I always send to all.",)] * 30 + [(None,), ("",)]
    df = spark.createDataFrame([(i, *t) for i, t in enumerate(texts)], "doc_id bigint, text string").repartition(3)
    got = reading.boilerplate(reading.written(df))
    assert got == mail.marks([foot])  # what one sender repeats is not
    assert mail.author(texts[0][0], got).endswith("and so on.") and foot[:10] not in mail.author(texts[0][0], got)
    assert reading.boilerplate(reading.written(df.limit(0))) == frozenset()


def test_author_survives_noise():
    rng = random.Random(4)
    parts = ["Content-Type: multipart/alternative; boundary=b", "--b", "--b--", "\n\n", "> ", "wrote:", "=C3", "Content-Transfer-Encoding: base64", "____________", "é\0\x0b", "<p>", "On 1"]
    for _ in range(2_000):
        mail.author("\n".join(rng.choice(parts) for _ in range(rng.randint(0, 12))))


def test_isotonic():
    x = np.arange(100.0)
    xs, ys = reading.isotonic(x, np.where(x < 50, 1.0, 3.0) + np.where(x % 2 == 0, 0.3, -0.3), 5)
    assert (np.diff(ys) >= 0).all() and (np.diff(xs) > 0).all()
    assert abs(np.interp(10, xs, ys) - 1) < 0.2 and abs(np.interp(90, xs, ys) - 3) < 0.2


def test_levels_of_held_out_documents(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/reading_labels.parquet")
    known = reading.graded(reading.written(docs), labels)
    cut = len(known) * 2 // 3
    ranker = reading.fit([p for p, _ in known[:cut]], [g for _, g in known[:cut]])
    pairs = [(ranker.level(p), g) for p, g in known[cut:] if p]
    error = [abs(a - g) for a, g in pairs]
    hit = [(a >= 3.5) == (g >= 3.5) for a, g in pairs]
    assert sum(error) / len(error) < 0.3 and sum(hit) / len(hit) > 0.95


def test_levels_of_odd_tables(spark):
    docs = spark.createDataFrame([(1, None, 1.0), (2, "", 1.0), (3, "We sat.", 1.0), (3, "We sat.", 1.0)], "doc_id bigint, text string, level double")
    labels = spark.createDataFrame([(3, "r", None), (None, "r", 3), (9, "r", 7)], "doc_id bigint, rater string, reading_level int")
    got = sorted(map(tuple, reading.levels(docs, labels).collect()), key=repr)
    assert [r[0] for r in got] == [1, 2, 3, 3] and got[0][1] is None and got[1][1] is None and got[2][1] is not None
    assert not reading.demanding(docs.limit(0), labels).count()
