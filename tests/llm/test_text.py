import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from lakeshelf.llm import fingerprints, html_text, language_id, token_records, toxicity

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")

# ---- fingerprints


def in_order(corpus):
    return sorted(corpus, key=lambda r: r[0])


def test_compared_with_next(docs, corpus):
    rows = in_order(corpus)
    band = fingerprints.lexicon(docs)
    counts = {}
    for r in rows:
        for t in fingerprints.terms(r[1] or ""):
            counts[t] = counts.get(t, 0) + 1
    low, high = max(2, len(rows) / fingerprints.RAREST), len(rows) / fingerprints.MOST_FREQUENT
    assert band.tolist() == sorted(t for t, n in counts.items() if low <= n <= high)
    found = {r["doc_id"]: r for r in fingerprints.compare_with_next(docs).collect()}
    prints = [fingerprints.fingerprint(r[1] or "", band) for r in rows]
    for k, (i, text, *_) in enumerate(rows):
        text, after = text or "", rows[(k + 1) % len(rows)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        changed, r = fingerprints.fingerprint(edited, band), found[i]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert (r["fingerprint"], r["edited_fingerprint"]) == (fingerprints.shown(prints[k]), fingerprints.shown(changed))
        assert r["near_edited"] == fingerprints.likeness(prints[k], changed)
        assert r["near_next"] == fingerprints.likeness(prints[k], prints[(k + 1) % len(rows)])
    assert len(found) == len(rows)


def test_likeness_follows_common_terms():
    rng = np.random.default_rng(0)
    words = [f"w{i}" for i in range(4000)]
    full = []
    for share in (0.0, 0.5, 0.9):
        got = []
        for _ in range(40):
            a = rng.choice(words[:2000], 200, replace=False)
            b = np.r_[a[: int(200 * share)], rng.choice(words[2000:], 200 - int(200 * share), replace=False)]
            none = np.empty(0, np.uint64)
            got.append(fingerprints.likeness(fingerprints.fingerprint(" ".join(a), none), fingerprints.fingerprint(" ".join(b), none)))
        full.append(np.mean(got))
    assert full[0] < 0.05 and abs(full[1] - 1 / 3) < 0.12 and full[2] > 0.6


def test_fingerprint_edges(spark, nothing):
    assert fingerprints.compare_with_next(nothing).count() == 0
    one = fingerprints.compare_with_next(spark.createDataFrame([(4, "abcd")], "doc_id long, text string")).first()
    assert one["near_next"] == 1.0 and one["edited_sha256"] == hashlib.sha256(b"abab").hexdigest()
    df = spark.createDataFrame([(1, None), (1, ""), (None, "...")], "doc_id long, text string")
    assert sorted(r["near_next"] for r in fingerprints.compare_with_next(df).collect()) == [0.0, 0.0, 1.0]


# ---- html


@pytest.mark.parametrize("html, text", [
    (None, ""), ("", ""), ("just text &amp; more", "just text & more"),
    ("<p>one<p>two <b>bold</b>\n  text<br>on", "one\ntwo bold text on"),
    ("<nav><a href=x>Home</a></nav><article><h1>T</h1><p>Long text that says a lot.</p></article><footer>End</footer>",
     "T\nLong text that says a lot."),
    ("<body><div class='main'><p>First words of it all.</p><div class='ad'>Buy</div><p>Second words &lt;b&gt; here.</p></div>"
     "<div class='sidebar'>s</div><div id='comments'><p>I think so.</p></div><form>Name <input></form><script>x='</p>'</script>",
     "First words of it all.\nSecond words <b> here."),
    ("<article><header><h1>Own head</h1></header><p>Body of it.</p><section class=\"comments\"><p>Bad</p></section></article>", "Own head\nBody of it."),
    ("<div>" * 3000 + "deep" + "</div>" * 3000, "deep"),
    ("<script>only</script>", ""), ("<ul><li>a<li>b</ul>", "a\nb"), ("<p>a<!-- <p>no</p> -->b</p>", "ab"),
])
def test_main_text(html, text):
    assert html_text.main_text(html) == text


ARTICLE = "<h1>Title of it</h1>" + "".join(f"<p>Sentence {i} of a text that goes on for a good while, with words.</p>" for i in range(6))
WHOLE = html_text.main_text(f"<article>{ARTICLE}</article>")
SIDE = "<div class='sidebar'><ul><li><a href=a>One</a><li><a href=b>Two</a></ul></div><div class='ad-container'>Buy this now</div>"


@pytest.mark.parametrize("open, close", [
    ("<div class='content no-sidebar'>", "</div>"), ("<div class='layout with-sidebar'>", "</div>"), ("<div class='nav-open'>", "</div>"),
    ("<div class='widget Blog'>", "</div>"), ("<form action=x>", "<input></form>"), ("<div id=page class=overlay>", "</div>"),
    ("<div class='comments-open'>", "</div>"), ("<header>", "</header>"),
])
@pytest.mark.parametrize("inner", ["article", "main", "div"])
def test_wrapper_named_like_boilerplate(open, close, inner):
    page = f"<body><nav><a href=x>Home</a></nav>{open}<{inner}>{ARTICLE}</{inner}>{SIDE}{close}<footer>End</footer>"
    assert html_text.main_text(page) == WHOLE


def test_sections_named_like_boilerplate():
    for name in ("related-work", "social-impact", "sharing-economy", "discussion"):
        section = f"<section class='{name}'><h2>Head</h2><p>What a section of the article says, in a sentence.</p></section>"
        got = html_text.main_text(f"<article>{ARTICLE}{section}<div class='related'><a href=a>Next</a></div><div id='share-bar'>Share it</div></article>")
        assert got == f"{WHOLE}\nHead\nWhat a section of the article says, in a sentence."
    assert html_text.main_text("<article class='post comments-open'><p>Text of it.</p></article>") == "Text of it."


def test_long_comments_and_teasers_go():
    comments = "<div id='comments'>" + "<article class='comment'><p>I have much to say about that, and so on and on.</p></article>" * 20 + "</div>"
    teasers = "<div class='related-posts'>" + "<article><a href=x>Another story</a><p>Short</p></article>" * 3 + "</div>"
    assert html_text.main_text(f"<body><main><article>{ARTICLE}</article>{teasers}{comments}</main>") == WHOLE
    assert html_text.main_text(f"<body><div>{ARTICLE}</div>{comments}") == WHOLE
    assert html_text.main_text("<form>Name <input> Password <input></form>") == ""
    assert html_text.main_text("<div class='ad'>An advert that is longer than the article.</div><article><p>Short article.</p></article>") == "Short article."


def test_extract_keeps_columns(spark):
    df = spark.createDataFrame([(1, "u", "<p>a b</p>", "x", 5), (None, None, None, None, 6)], "page_id long, url string, html string, n_chars string, text int")
    got = html_text.extract(df)
    assert got.columns == ["page_id", "url", "n_chars", "text"] and sorted(map(tuple, got.collect()), key=str) == [(1, "u", "x", "a b"), (None, None, None, "")]
    assert html_text.extract(df.limit(0)).count() == 0


# ---- token records


def test_checksum_is_castagnoli():
    assert token_records.crc32c([b"123456789"])[0] == 0xE3069283
    data = [bytes(range(k % 256)) * 3 + b"abcd" for k in range(300)]
    slow = [token_records.masked_of_head(d) for d in data]
    assert token_records.masked(token_records.crc32c(data)).tolist() == slow


def test_damaged_records_are_found():
    good = b"".join(token_records.frames([b"payload one", b"payload two" * 50]))
    assert next(token_records.read_frames(pa.BufferReader(good))) == [b"payload one", b"payload two" * 50]
    for place in (2, 14, len(good) - 1):
        bad = bytearray(good)
        bad[place] ^= 1
        with pytest.raises(ValueError):
            list(token_records.read_frames(pa.BufferReader(bytes(bad))))
    with pytest.raises(ValueError):
        list(token_records.read_frames(pa.BufferReader(good[:-3])))


def test_round_trip_and_index(docs, corpus):
    from tokenizers import Tokenizer

    shards = token_records.write_shards(docs, TOKENIZER)
    found = sorted(map(tuple, token_records.read_shards(shards).collect()))
    tokenizer, start, want, ids = Tokenizer.from_file(TOKENIZER), 0, [], {}
    for i, text, *_ in in_order(corpus):
        ids[i] = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        want.append((i, start, len(ids[i]), zlib.crc32(ids[i].tobytes())))
        start += len(ids[i])
    assert found == want
    shard = shards.orderBy(F.desc("n_docs")).first()
    doc_id, got = token_records.read_record(shard["path"], shard["n_docs"] - 1)
    assert got.tolist() == ids[doc_id].tolist()


def test_runs_encode_like_texts():
    encoder = token_records.Encoder(TOKENIZER)
    texts = ["It's DON'T 12 34. x.. a.b, 3.5% u#", "a　b \x1cc\x0bd <|endoftext|> x<|ENDOFTEXT|>y ́e é ΣΣ \x85z 'S", "", "the. , a|"]
    want = [e.ids for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [e[:-1].tolist() for e in encoder.encode(texts)] == want
    encoder._reset()
    assert [e[:-1].tolist() for e in encoder.encode(texts)] == want


def test_random_strings_encode_like_texts():
    rng, encoder = random.Random(8), token_records.Encoder(TOKENIZER)
    assert encoder.one_piece and encoder.between
    letters = "abczAÉÉéßŠšΣσςИйЖaͅ日本가각ªºǅⅷ①²0123 \t\n.,!?;:|$%&#*'<|>-_\u00a0\u2028\u0301\U0001f600"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(40))) for _ in range(4000)]
    texts += ["word. wörd! 'tis it's l'eau <|endoftext|> x<|startoftext|>y A<|B", "<|endoftext|>", "a\x00b\x1fc \x85d", " ", ""]
    want = [e.ids for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    for at in range(0, len(texts), 97):
        assert [e[:-1].tolist() for e in encoder.encode(texts[at : at + 97])] == want[at : at + 97]


def test_records_of_nothing(spark, nothing):
    assert token_records.write_and_read(nothing, TOKENIZER).count() == 0
    df = spark.createDataFrame([(None, None), (None, "a"), (2, ""), (2, "")], "doc_id long, text string")
    assert [r["n_tokens"] for r in token_records.write_and_read(df, TOKENIZER).orderBy("start").collect()] == [1, 2, 1, 1]


# ---- language


def speech(rng, kind, n=40):
    parts = {"en": "the ing th er on".split(), "de": "sch ung ein ch er".split(), "fr": "eau que le ré ou".split(), "xx": "zq qx kz xk vv".split()}[kind]
    return " ".join("".join(rng.choice(parts, rng.integers(1, 4))) for _ in range(n))


def test_languages_are_learned(spark):
    rng = np.random.default_rng(1)
    rows = [(i, speech(rng, k), k) for i, k in enumerate(["en", "de", "fr", "xx"] * 40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.fit(df, F.floor(F.col("doc_id") / 4) % 2 == 0)
    found = {r["doc_id"]: r for r in language_id.classify(df, model, "doc_id").collect()}
    held_out = [i for i, *_ in rows if i // 4 % 2]
    assert np.mean([found[i]["lang_pred"] == rows[i][2] for i in held_out]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in found.values())
    odd = spark.createDataFrame([(1, None, "en"), (2, "", "en"), (3, "12 .. 3", None), (4, rows[0][1], None)], "doc_id long, text string, lang string")
    assert [(r[1], r[2] > 0) for r in sorted(language_id.classify(odd, model, "doc_id").collect())] == [("und", False)] * 3 + [("en", True)]
    extra = odd.withColumn("score", F.lit("s")).withColumn("lang_pred", F.lit(1))
    assert [tuple(r) for r in language_id.keep_known(extra, model).collect()] == [(4, rows[0][1], None, "s", 1)]


def test_nothing_to_learn(spark, nothing):
    model = language_id.fit(nothing)
    assert model.predict("some text") == ("und", 0.0) and language_id.classify(nothing, model, "doc_id").count() == 0
    one = spark.createDataFrame([(1, "some text", "en"), (2, "other", None)], "doc_id long, text string, lang string")
    assert language_id.fit(one).predict("bonjour") == ("en", 1.0)


def test_what_was_not_learned_goes(spark):
    """Four languages in two families: of the machines' margins one is never below 0."""
    rng = np.random.default_rng(4)
    parts = {"en": "the ing th er on", "de": "sch ung ein ch er", "fr": "eau que le ré ou", "es": "ción que el ñ os", "fi": "kää yö uu hto jk", "ru": "ого ста ни ть про"}

    def said(kind, n):
        return " ".join("".join(rng.choice(parts[kind].split(), rng.integers(1, 4))) for _ in range(n))

    rows = [(i, said(k, int(rng.integers(2, 80))), k) for i, k in enumerate(["en", "de", "fr", "es"] * 60)]
    model = language_id.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    random = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz  "), 200)) for _ in range(20)]
    texts = [(1, said(k, n)) for k in ("en", "de", "fr", "es") for n in (2, 5, 200) for _ in range(10)]
    texts += [(0, t) for t in random] + [(0, said(k, n)) for k in ("fi", "ru") for n in (15, 200) for _ in range(10)] + [(0, "..."), (0, None)]
    kept = language_id.keep_known(spark.createDataFrame(texts, "doc_id long, text string"), model).collect()
    assert sorted((r[0], r[1]) for r in kept) == sorted(t for t in texts if t[0])


def test_every_language_is_learned(spark):
    rng = np.random.default_rng(9)
    rows = []
    for k in range(70):
        parts = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 3)) for _ in range(6)]
        rows += [(len(rows) + i, " ".join("".join(rng.choice(parts, 2)) for _ in range(30)), f"x{k}") for i in range(4 if k < 64 else 3)]
    model = language_id.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert len(model.langs) == 70 and np.mean([model.predict(t)[0] == k for _, t, k in rows]) > 0.95


def test_machines_are_the_same_in_tasks(spark, monkeypatch):
    rng = np.random.default_rng(2)
    rows = [(i, speech(rng, k), k) for i, k in enumerate(["en", "de", "fr", "xx"] * 25)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    want = language_id.fit(df, sample=22)
    monkeypatch.setattr(language_id, "DRIVER_ROWS", 0)
    got = language_id.fit(df, sample=22)
    assert got.langs == want.langs and len(got.likeness) == 4 and len(got.family_w) == 3
    assert [got.predict(t) for _, t, _ in rows] == [want.predict(t) for _, t, _ in rows]


# ---- toxicity


def test_toxicity_is_learned(spark):
    rng = np.random.default_rng(5)
    common, bad = [f"{a}{b}" for a in "the ing ther onal redi stan".split() for b in "a e ou ing er".split()], ["grobnak", "vilefoot", "scumlard"]
    rows, labels = [], []
    for i in range(240):
        w = list(rng.choice(common, 60))
        if i % 4 == 0:
            for _ in range(4):
                w[rng.integers(60)] = bad[rng.integers(3)]
        rows.append((i, " ".join(w)))
        labels.append((i, int(i % 4 == 0)))
    df, lab = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    scorer = toxicity.fit(df, lab, F.col("doc_id") % 3 != 1)
    found = {r["doc_id"]: r for r in toxicity.score(df, scorer, "doc_id").collect()}
    held = [i for i, _ in rows if i % 3 == 1]
    assert np.mean([found[i]["predicted"] == labels[i][1] for i in held]) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in found.values())
    odd = spark.createDataFrame([(1, None, 0.5), (2, "", 0.1), (3, "...", 0.2)], "doc_id long, text string, score double")
    assert len({r["score"] for r in toxicity.score(odd, scorer, "doc_id").collect()}) == 1


def test_no_labels(spark, nothing):
    labels = spark.createDataFrame([(1, None), (None, 1), (7, 1)], "doc_id long, toxic int")
    scorer = toxicity.fit(nothing, labels)
    assert scorer.score("anything") == 0.0 and toxicity.score(nothing, scorer, "doc_id").count() == 0


def test_repeated_ids_do_not_grow_what_is_learned_from(spark, monkeypatch):
    """One id in 20,000 rows, and rows without an id: the driver gets each id's text once."""
    rows = [(1, f"the words of an ordinary text {k}", "en") for k in range(20_000)]
    rows += [(i, f"les mots du texte {i}", "fr") for i in range(2, 40)] + [(None, f"a text without an id {k % 5}", "en") for k in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    taken = []
    monkeypatch.setattr(language_id.Classifier, "learn", lambda self, x, langs, sizes: taken.append(langs) or self)
    language_id.fit(docs)
    assert len(taken[0]) == taken[0].count("en") + 38 and taken[0].count("en") == 6
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0)], "doc_id long, toxic int")
    monkeypatch.setattr(toxicity, "Scorer", lambda texts, marks: taken.append((texts, marks)))
    toxicity.fit(docs.drop("lang"), labels)
    assert taken[1] == (["the words of an ordinary text 0", "les mots du texte 2", "les mots du texte 3"], [1, 0, 0])
