"""Language ID, decontamination and the language model."""

import math
import random
import zlib
from collections import Counter

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F
from samples import SCHEMA, docs, none, prose, rows, staging  # noqa: F401

from tripledger.llm import decontam, langid, trie_lm
from tripledger.llm.eliasfano import EliasFano, load, save
from tripledger.llm.tokens import ALNUM, slices, words

SAMPLES = {"en": "the house and the river with those things that were there", "de": "das haus und der fluss mit den dingen die dort waren",
           "fr": "la maison et le fleuve avec les choses qui étaient là"}


# ---- language ID

@pytest.fixture
def labelled(spark):
    rng = random.Random(4)
    made = []
    for k in range(300):
        lang = rng.choice(list(SAMPLES))
        made.append((k, " ".join(rng.choices(SAMPLES[lang].split(), k=rng.randrange(4, 40))), lang, f"{lang}.example.org", 0))
    return spark.createDataFrame(made, SCHEMA).repartition(4)


def test_held_out_accuracy_and_what_is_rejected(spark, labelled, staging):
    model = langid.fit(labelled.where("doc_id % 5 <> 0").selectExpr("text", "lang AS label"), staging)
    asked = labelled.where("doc_id % 5 = 0").selectExpr(
        "doc_id", "text", "cast(null as string) AS declared", "cast(null as string) AS host", "cast(null as string) AS suffix", "lang AS truth")
    found = langid.identify(asked, model, staging).collect()
    assert sum(r.language == r.truth for r in found) >= 0.97 * len(found)
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "12 34 !!"), (4, "xq zj " * 200)], "doc_id long, text string").selectExpr(
        "*", "'en' AS declared", "cast(null as string) AS host", "cast(null as string) AS suffix")
    assert {r.doc_id: r.kept for r in langid.identify(odd, model, staging).collect()} == dict.fromkeys(range(1, 5), False)
    assert langid.identify(odd.limit(0), model, staging).count() == 0


def test_other_evidence_decides_where_the_text_is_weak(spark, labelled, staging):
    model = langid.fit(labelled.selectExpr("text", "lang AS label"), staging)
    weak = " la "

    def language(declared, host, suffix):
        extra = [(k, SAMPLES["de"], None, "w.kiosk.de", None) for k in range(60)]
        df = spark.createDataFrame([(-1, weak, declared, host, suffix), *extra], "doc_id long, text string, declared string, host string, suffix string")
        return langid.identify(df, model, staging).where("doc_id = -1").first()
    assert language("fr", None, None).language == "fr"
    assert language(None, None, "fr").confidence > language(None, None, "de").confidence
    # Its own host speaks against the text, a sister host through the parent domain only.
    own, sister, other = (language(None, host, None) for host in ("w.kiosk.de", "x.kiosk.de", "y.other.org"))
    assert own.language == "de" or own.confidence < sister.confidence
    assert sister.language == "de" or sister.confidence < other.confidence


def test_markup_and_address(spark):
    pages = [('<html lang="de-AT">', "http://a.fr/x"), ("<!DOCTYPE html><HTML class=a LANG=fr>", "b.co.uk"), ("<p lang=es>", "x.org"), (None, None),
             ("<!--" + "x" * 9000 + "-->\n<html dir=ltr lang='pt-BR'>", "x.pt")]
    got = spark.createDataFrame(pages, "html string, host string").select(
        langid.markup_language(F.col("html")), langid.suffix_language(F.regexp_replace("host", "^http://|/.*$", ""))).collect()
    assert [tuple(r) for r in got] == [("de", "fr"), ("fr", "en"), (None, None), (None, None), ("pt", "pt")]


def test_posterior_against_plain_python(spark, labelled, staging):
    """Every kind of evidence, from the model's tables on, by plain loops."""
    model = langid.fit(labelled.selectExpr("text", "lang AS label"), staging)
    names, weight, smooth = list(model), 60, 20.0
    rng = random.Random(8)
    made = []
    for k in range(80):
        text = rng.choice([None, "", "7 8", " ".join(rng.choices(SAMPLES[rng.choice(["en", "de", "fr"])].split(), k=rng.randrange(1, 30)))])
        made.append((k, text, rng.choice(["en", "de", "xx", None]), rng.choice(["a.x.de", "b.x.de", "x.de", "solo", None]),
                     rng.choice(["de", "fr", None]), "old"))
    df = spark.createDataFrame(made, "doc_id long, text string, declared string, host string, suffix string, ll string")

    def grams(text):
        data = (text or "").translate(brute.AZ).encode()
        code = [0 if 48 <= b < 58 else int(langid.LETTERS[b]) for b in data]
        found = []
        for a, b, c in zip(code, code[1:], code[2:]):
            if (a | c) * b or a & c:
                found.append((((a << 16) | (b << 8) | c) * 2654435761 & 0xFFFFFFFF) >> 17)
        return found

    def softmax(logs):
        top = max(logs)
        return [math.exp(x - top) / sum(math.exp(y - top) for y in logs) for x in logs]
    own, counts = {}, Counter()
    for k, text, _, host, _, _ in made:
        g = grams(text)
        scale = min(1.0, weight / max(1, len(g)))
        own[k] = len(g), [scale * sum(float(model[n][b]) for b in g) for n in names]
        if g:
            for i, p in enumerate(softmax(own[k][1])):
                for level in {("all",), ("host", host), *([("up", host.split(".", 1)[1])] if host and "." in host else [])}:
                    counts[level, i] += p

    def prior(level, towards):
        n = [counts[level, i] for i in range(len(names))]
        return [(x + smooth * t) / (sum(n) + smooth) for x, t in zip(n, towards)]
    whole = prior(("all",), [1 / len(names)] * len(names))
    for r in langid.identify(df, model, staging).collect():
        k, _, declared, host, suffix, _ = made[r.doc_id]
        up = prior(("up", host.split(".", 1)[1]), whole) if host and "." in host else whole
        before = prior(("host", host), up) if host and any(counts[("host", host), i] for i in range(len(names))) else whole
        logs = [a + math.log(b) for a, b in zip(own[k][1], before)]
        for said, right in ((declared, 0.8), (suffix, 0.6)):
            if said in names[:-1]:
                logs = [x + math.log(1 / (len(names) - 1) if n == "und" else right if n == said else (1 - right) / (len(names) - 2))
                        for x, n in zip(logs, names)]
        p = softmax(logs)
        language = names[p.index(max(p))] if own[k][0] else "und"
        assert (r.language, r.ll) == (language, "old") and math.isclose(r.confidence, max(p), rel_tol=1e-5)
        assert r.kept == (language != "und" and max(p) >= 0.5)


def test_every_label_is_learned_from_distinct_texts(spark, staging):
    made = [(f"common words {k} of one kind" if k % 2 else "the same text again", "en") for k in range(400)]
    df = spark.createDataFrame(made + [("seltene worte", "de"), (None, "fr"), ("x y", None)], "text string, label string")
    assert list(langid.fit(df.repartition(4), staging, rows=20)) == ["de", "en", "und"]
    assert langid._chosen(df.where("label = 'en'"), 20, 5, staging).count() == 20
    assert list(langid.fit(df.limit(0), staging)) == ["und"]


def test_pages_are_judged_by_all_their_evidence(spark, labelled, staging):
    model = langid.fit(labelled.selectExpr("text", "lang AS label"), staging)
    html = "<!-- the --><html lang=fr><script>the house and the river</script><p>la <b>maison</b></p></html>"
    pages = spark.createDataFrame([(1, "http://w.x.fr/a", html), (2, "odd", "<p>" + SAMPLES["de"] + "</p>"), (3, None, None)],
                                  "page_id long, url string, html string")
    rows = {r.page_id: r for r in langid.page_rows(pages).collect()}
    assert (rows[1].text.split(), rows[1].declared, rows[1].host, rows[1].suffix) == (["la", "maison"], "fr", "w.x.fr", "fr")
    found = {r.page_id: r for r in langid.identify(langid.page_rows(pages), model, staging).collect()}
    assert (found[1].language, found[2].language, found[3].kept) == ("fr", "de", False)
    assert (rows[2].host, rows[3].host) == (None, None)


def test_rejecting_keeps_clean_documents_and_columns(docs, rows, none, staging):
    kept = langid.drop_rejected(docs, staging)
    assert kept.columns == docs.columns
    blank = sum(1 for r in rows if len(r[1] or "") < 3 or not (r[1] or "").strip())
    assert kept.count() == len(rows) - blank
    assert langid.drop_rejected(none, staging).count() == 0


# ---- decontamination

def edit_of(rng, item, edits):
    item = list(item)
    for _ in range(edits):
        at, what = rng.randrange(len(item)), rng.randrange(3)
        if what == 0:
            item[at] = f"e{rng.randrange(99)}"
        elif what == 1:
            item.insert(at, f"e{rng.randrange(99)}")
        elif len(item) > 1:
            del item[at]
    return item


def distance(item, passage):
    """Least edit distance of ``item`` to any passage, by the plain recurrence."""
    last = [0] * (len(passage) + 1)
    for i, a in enumerate(item, 1):
        row = [i]
        for j, b in enumerate(passage, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (a != b)))
        last = row
    return min(last)


def planted(seed=1):
    rng = random.Random(seed)
    items = [(k, [f"w{rng.randrange(300)}" for _ in range(rng.choice([2, 7, 15, 30, 55]))]) for k in range(30)]
    items += [(30, ["same"]), (31, []), (None, [f"n{k}" for k in range(20)])]
    texts = []
    for k in range(90):
        item = items[rng.randrange(30)][1]
        middle = edit_of(rng, item, int(rng.choice([0, 0.1, 0.2, 0.3]) * len(item))) if k % 3 else []
        texts.append([*prose(rng, rng.randrange(0, 40), 300).split(), *middle, *prose(rng, rng.randrange(0, 40), 300).split()])
    texts += [items[4][1] * 30, [], items[-1][1]]
    return items, texts


@pytest.mark.parametrize("block_words", [1 << 20, 200])
def test_contamination_against_brute_force(spark, staging, block_words):
    items, texts = planted()
    docs = [(k, "; ".join(t).upper() if k % 2 else " ".join(t), None, None, 0) for k, t in enumerate(texts)] + [(999, None, None, None, 0)]
    frame = spark.createDataFrame([(i, " ".join(w)) for i, w in items] + [(77, None)], "item_id long, text string")
    want = {(k, i) for k, t in enumerate(texts) for i, w in items if len(w) > 1 and distance(w, t) <= int(0.2 * len(w))}
    found = decontam.contaminated(spark.createDataFrame(docs, SCHEMA).repartition(3), frame, staging, block_words=block_words)
    got = [(r.doc_id, r.item_id) for r in found.collect()]
    assert len(got) == len(set(got)) and set(got) <= want
    assert len(got) >= 0.98 * len(want)
    exact = {(k, i) for k, t in enumerate(texts) for i, w in items if len(w) > 1 and distance(w, t) == 0}
    assert exact <= set(got)


def test_clean_documents_and_columns_stay(spark, docs, rows, none, staging):
    passage = rows[10][1].split()[:20]
    items = spark.createDataFrame([(1, " ".join(passage)), (2, "nothing like this is in any of them")], "item_id long, text string")
    kept = decontam.drop_contaminated(docs, items, staging)
    assert kept.columns == docs.columns
    gone = sum(1 for r in rows if distance(passage, (r[1] or "").split()) <= int(0.2 * len(passage)))
    assert kept.count() == len(rows) - gone and gone
    assert decontam.drop_contaminated(none, items, staging).count() == 0
    assert decontam.drop_contaminated(docs, items.limit(0), staging).count() == len(rows)


# ---- language model

@pytest.mark.parametrize("n, universe", [(0, 9), (1, 1), (9, 3), (800, 900), (800, 1 << 44), (5000, 1 << 62)])
def test_sequences_find_successors(tmp_path, n, universe):
    rng = np.random.default_rng(n)
    values = np.sort(rng.integers(0, universe, n)).astype(np.uint64)
    save(str(tmp_path / "x"), {"key": EliasFano.encode(values, universe), "other": np.arange(3, dtype=np.uint16)})
    mapped = load(str(tmp_path / "x"))
    assert mapped["other"].tolist() == [0, 1, 2] and (mapped["key"].get(np.arange(n)) == values).all()
    asked = np.concatenate([values, rng.integers(0, universe + 9, 300).astype(np.uint64)])
    at, equal = mapped["key"].successor(asked)
    assert (at == np.searchsorted(values, asked)).all() and (equal == np.isin(asked, values)).all()


def reference(rows):
    """Plain counts and the recurrences of the model, with one discount for each order."""
    held = {i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1 for i, *_ in rows}
    one, two, three = Counter(), Counter(), Counter()
    for i, text, *_ in rows:
        if not held[i]:
            s = ["\1", *brute.words_of(text), "\0"]
            one.update(s[1:])
            two.update(zip(s, s[1:]))
            three.update(zip(s, s[1:], s[2:]))
    return held, one, two, three


@pytest.mark.parametrize("shard_bytes", [12 << 20, 3000])
def test_scores_against_plain_counts(docs, rows, staging, shard_bytes):
    held, one, two, three = reference(rows)
    levels = trie_lm.learn(docs.where(~trie_lm.held_out(F.col("doc_id"))), staging, shard_bytes)
    assert len(levels.bounds) >= 3 or shard_bytes > 3000
    tokens, kinds = sum(one.values()), len(one)
    text_of = {i: t for i, t, *_ in rows if i is not None}

    def discount(counts):
        a, b = (sum(v == k for v in counts.values()) for k in (1, 2))
        return min(0.95, max(0.1, a / (a + 2 * b))) if a else 0.5
    from2, from3 = Counter(), Counter()
    kinds2, kinds3 = Counter(), Counter()
    for (a, _), v in two.items():
        from2[a] += v
        kinds2[a] += 1
    for (a, b, _), v in three.items():
        from3[a, b] += v
        kinds3[a, b] += 1
    d2, d3 = discount(two), discount(three)

    def unigram(w):
        return (one[w] + 0.5) / (tokens + 0.5 * (kinds + 1))

    def bigram(a, b):
        return max(two[a, b] - d2, 0) / from2[a] + d2 * kinds2[a] / from2[a] * unigram(b) if from2[a] else unigram(b)

    def trigram(a, b, c):
        return max(three[a, b, c] - d3, 0) / from3[a, b] + d3 * kinds3[a, b] / from3[a, b] * bigram(b, c) if from3[a, b] else bigram(b, c)
    for r in trie_lm.score(docs, levels).collect():
        if r.doc_id is None:
            continue
        s = ["\1", *brute.words_of(text_of[r.doc_id]), "\0"]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (
            held[r.doc_id], len(s) - 1, sum(one[w] > 0 for w in s[1:]), tokens)
        assert math.isclose(r.base_score, sum(math.log10(unigram(w)) for w in s[1:]), rel_tol=1e-12)
        assert r.score <= 0
        want = math.log10(bigram(*s[:2])) + sum(math.log10(trigram(*s[k:k + 3])) for k in range(len(s) - 2))
        assert abs(r.score - want) <= 5e-4 * len(s)


def test_held_out_texts_with_phrases_score_better_than_words_alone(spark, staging):
    rng = random.Random(6)
    phrases = [prose(rng, 6) for _ in range(40)]
    made = [(k, " ".join(rng.choices(phrases, k=rng.randrange(1, 12))), None, None, 0) for k in range(400)]
    docs = spark.createDataFrame(made, SCHEMA)
    found = trie_lm.score(docs, trie_lm.learn(docs.where(~trie_lm.held_out(F.col("doc_id"))), staging)).where("held_out")
    r = found.selectExpr("sum(score) / sum(n_tokens) AS model", "sum(base_score) / sum(n_tokens) AS base").first()
    assert r.model > 0.6 * r.base


def test_scores_do_not_depend_on_the_shards(spark, staging):
    """One word is a third of all tokens."""
    rng = random.Random(12)
    made = [(k, " ".join("hot" if rng.random() < 0.33 else prose(rng, 1) for _ in range(rng.randrange(1, 120))), None, None, 0)
            for k in range(150)]
    docs = spark.createDataFrame(made, SCHEMA).repartition(4)
    found = []
    for size in (12 << 20, 20_000, 1000):
        levels = trie_lm.learn(docs, staging, size)
        found.append({r.doc_id: r.score for r in trie_lm.score(docs, levels).collect()})
    assert len(levels.bounds) > 30
    assert all(abs(found[0][k] - other[k]) < 1e-9 for other in found[1:] for k in found[0])


def test_too_many_words_are_an_error(spark, docs, staging, monkeypatch):
    monkeypatch.setattr(trie_lm, "_vocabulary", lambda *_: trie_lm.Vocabulary([], [], 0, 1 << 32, 1))
    with pytest.raises(ValueError, match="32 bits"):
        trie_lm.learn(docs, staging)


def test_each_context_adds_up_to_one(docs, staging):
    levels = trie_lm.learn(docs, staging, 3000)
    size = levels.vocabulary.size
    every = np.arange(size)
    for a, b in [(size, 3), (5, 9), (0, 0), (7, 2)]:
        seq = np.stack([np.full(size, size), np.full(size, a), np.full(size, b), every], axis=1).ravel()
        bounds = np.arange(0, 4 * size + 1, 4)
        total = (10 ** levels.score(seq, bounds)[3::4]).sum()
        unknown = levels.vocabulary.unigram(np.zeros(1))[0]
        assert abs(total - 1) < 0.01 + unknown


def test_nothing_to_learn_from_and_nothing_to_score(docs, rows, none, staging):
    found = trie_lm.score(docs, trie_lm.learn(none, staging)).collect()
    assert len(found) == len(rows) and all(r.train_tokens == 0 and r.n_known == 0 and r.score == r.base_score for r in found)
    assert trie_lm.score(none, trie_lm.learn(docs, staging)).count() == 0


# ---- words

def test_words_of_slices_are_those_of_the_texts(monkeypatch):
    import pyarrow as pa

    from tripledger.llm import tokens
    monkeypatch.setattr(tokens, "SLICE", 200)
    monkeypatch.setattr(tokens, "CHUNK", 64)
    texts = ["", "a b", "ab", "b a", "", "é É x" * 200, "ab", "AB  ab\n"] + [prose(random.Random(k), 50) for k in range(9)]
    seen, count = {}, 0
    for lo, hi, data, bounds in slices(pa.array(texts)):
        hashes, cuts = words(data, bounds, tokens.VISIBLE)
        for row in range(lo, hi):
            got = hashes[cuts[row - lo]:cuts[row - lo + 1]].tolist()
            want = brute.words_of(texts[row])
            assert len(got) == len(want)
            for h, w in zip(got, want):
                assert seen.setdefault(w, h) == h
            count += len(got)
    assert len(set(seen.values())) == len(seen) and count > 400 and ALNUM.sum() == 190
