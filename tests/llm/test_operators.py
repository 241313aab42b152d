"""The operators on small tables: brute force, exact round trips, and odd rows."""

import hashlib
import random
import re
from collections import Counter
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from tablewright.llm import chat, decontaminate, langid, minhash, mixing, quality, secrets, substrings, suffixes, urls
from tablewright.llm.catalog import URL_RULES
from tablewright.llm.components import components
from tests.helpers import rows, same_rows

SPACE = r"[^\x20\x09-\x0D]+"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, n_words long, copies string"


def corpus():
    """Copies, near copies, shared passages, runs, and odd texts; with columns whose names clash."""
    draw = random.Random(4)
    words = [f"w{i}" for i in range(400)] + ["the", "of", "é", "x"] * 30
    text = lambda n: " ".join(draw.choice(words) for _ in range(n))
    passage = text(60)
    texts = [None, "", " \n\t ", "one", "two words", "a " * 90, "\u00e9" * 300, "b" * 450, text(3000)]
    for _ in range(12):
        base = text(draw.randint(40, 120)).split()
        texts.append(" ".join(base))
        for _ in range(draw.randint(0, 4)):
            base[draw.randrange(len(base))] = draw.choice(words)
            texts.append(" ".join(base))
        texts.append(text(draw.randint(5, 40)) + "\n" + passage + " " + text(draw.randint(0, 60)))
    texts += [texts[9], texts[9], texts[9].upper()]
    found = [(i, t, draw.choice(["en", "de", None]), None, len(t or ""), 1, "c") for i, t in enumerate(texts)]
    return [*found, (None, text(50), "en", "s", 1, None, None), (11, texts[11], "en", "s", 1, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), DOCS).repartition(4).cache()


@pytest.fixture(scope="module")
def labels(spark, docs):
    found = docs.select("doc_id", (F.col("doc_id") % 3 > 0).cast("int").alias("quality"))
    return found.withColumn("toxic", F.when(F.col("doc_id") % 7 > 0, 0)).cache()


def removed(units, size):
    """Which units brute force removes from each of the sequences."""
    seen = Counter(tuple(u[i : i + size]) for u in units for i in range(len(u) - size + 1))
    for u in units:
        gone = [False] * len(u)
        for i in range(len(u) - size + 1):
            if seen[tuple(u[i : i + size])] > 1:
                gone[i : i + size] = [True] * size
        yield gone


def test_repeated_words(docs):
    texts = docs.select("doc_id", "text").collect()
    units = [(r["text"] or "").encode().split() for r in texts]
    expected = []
    for r, u, gone in zip(texts, units, removed(units, 35)):
        kept = b" ".join(w for w, g in zip(u, gone) if not g)
        expected.append((r["doc_id"], len(u), sum(gone), hashlib.sha256(kept).hexdigest()))
    found = substrings.without_repeated_words(docs)
    order = lambda r: [(v is None, v) for v in r]
    assert rows(found, "doc_id", "n_words", "n_removed", "kept_sha256") == sorted(expected, key=order)


def test_repeated_bytes(docs):
    texts = docs.select("doc_id", "text").collect()
    units = [(r["text"] or "").encode() for r in texts]
    expected = []
    for r, u, gone in zip(texts, units, removed(units, 200)):
        kept = bytes(b for b, g in zip(u, gone) if not g)
        spans = len(re.findall("1+", "".join("1" if g else "0" for g in gone)))
        expected.append((r["doc_id"], len(u), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    found = suffixes.without_repeated_bytes(docs)
    order = lambda r: [(v is None, v) for v in r]
    assert rows(found, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == sorted(expected, key=order)


def expected_components(texts, size, percent):
    sets = {}
    for i, text in texts.items():
        lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        w = re.findall(SPACE, lowered)
        sets[i] = {tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))} if w else set()
    parent = {i: i for i in sets}
    find = lambda i: i if parent[i] == i else find(parent[i])
    for a, b in combinations(sorted(sets), 2):
        if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            low, high = sorted((find(a), find(b)))
            parent[high] = low
    return {i: (len(s), find(i)) for i, s in sets.items()}


@pytest.mark.parametrize("block, copies", [(500_000, 20), (300, 1000), (500_000, 0.001)])
@pytest.mark.parametrize("size", [2, 5])
def test_near_copies(docs, monkeypatch, size, block, copies):
    """In one task, in small blocks, and by leaders alone."""
    monkeypatch.setattr(minhash, "BLOCK", block)
    monkeypatch.setattr(minhash, "COPIES", copies)
    known = docs.where("doc_id is not null")
    expected = expected_components({r["doc_id"]: r["text"] for r in known.collect()}, size, 80)
    found = minhash.near_copies(docs, shingle=size).collect()
    assert len(found) == docs.count()
    for r in found:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert (r["n_shingles"], r["component_id"]) == expected[r["doc_id"]]
            assert r["kept"] == (r["doc_id"] == r["component_id"])


def test_first_of_each_component_stays(docs):
    kept = minhash.keep_first(docs)
    assert kept.columns == docs.columns
    same = expected_components({r["doc_id"]: r["text"] for r in docs.collect() if r["doc_id"] is not None}, 5, 80)
    assert {r["doc_id"] for r in kept.collect()} == {None, *(low for _, low in same.values())}


def test_components_of_a_long_path(spark):
    links = spark.range(200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    hub = spark.range(500).select(F.lit(1000).cast("long").alias("a"), (F.col("id") + 1001).alias("b"))
    low = components(links.union(hub))
    assert rows(low.groupBy("low").count()) == [(0, 200), (1000, 500)]


def test_base_measures(docs, labels):
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    for r in quality.judge(docs, labels).collect():
        text = texts[r["doc_id"]]
        w = re.findall(SPACE, text)
        seen = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
        again = {k for i in range(len(w) - 4) if seen[tuple(w[i : i + 5])] > 1 for k in range(i, i + 5)}
        lines = [line for line in text.split("\n") if re.search(SPACE, line)]
        expected = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(again))
        assert tuple(r[1:6]) == expected
        assert r["base_failed"] == (len(w) < 10 or 100 * len(again) > 20 * len(w))
        assert not (r["base_failed"] and r["kept"])


def test_exact_bound():
    for failures, trials, error in ((0, 100, 0.05), (3, 200, 0.01), (20, 50, 0.1)):
        p = quality.upper_bound(failures, trials, error)
        from math import comb

        tail = sum(comb(trials, k) * p**k * (1 - p) ** (trials - k) for k in range(failures + 1))
        assert abs(tail - error) < 1e-6
    assert quality.upper_bound(5, 5, 0.05) == 1.0
    # Many trials: near the normal approximation, from a bounded number of terms.
    assert abs(quality.upper_bound(9_000_000, 1_000_000_000, 0.001) - 0.009 - 3.09 * (0.009 * 0.991 / 1e9) ** 0.5) < 1e-7


def test_certified_cutoffs_reject_bad_and_keep_good(spark):
    """2,000 good documents without symbols and 500 bad ones full of them."""
    words = lambda tail: F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.lit(30)), lambda i: F.concat(F.lit("w"), (i + F.col("id") * 31).cast("string"), F.lit(tail))))  # noqa: E731, E501
    good = spark.range(2000).select(F.col("id").alias("doc_id"), words("").alias("text"), F.lit(1).alias("quality"))
    bad = spark.range(2000, 2500).select(F.col("id").alias("doc_id"), words("$$").alias("text"), F.lit(0).alias("quality"))
    both = good.union(bad).withColumn("lang", F.lit("en"))
    found = quality.judge(both.drop("quality"), both).join(both, "doc_id")
    assert rows(found.groupBy("quality", "kept").count()) == [(0, False, 500), (1, True, 2000)]


def test_copies_certify_no_more_than_one_text(spark):
    """500 copies of one good text and of one bad one are two trials: too few for any cutoff."""
    text = F.when(F.col("id") < 500, F.lit("plain words " + " ".join(f"w{i}" for i in range(30)))).otherwise(
        F.lit(" ".join(f"w{i}$$" for i in range(30)))
    )
    docs = spark.range(1000).select(
        F.col("id").alias("doc_id"), text.alias("text"), F.lit("en").alias("lang"), F.lit("x").alias("digest"), F.lit(1).alias("m")
    )
    labels = docs.select("doc_id", (F.col("doc_id") < 500).cast("int").alias("quality"))
    assert quality.judge(docs, labels).where("not kept").count() == 0
    known = quality.known_measures(docs, "doc_id", "lang")
    assert quality.certify(known, labels).cutoffs == {"en": {}}


def test_languages_of_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    found = langid.identify(docs, ~held_out).join(docs.where(held_out).select("doc_id", "lang"), "doc_id")
    assert found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] >= 0.97


def test_texts_without_letters_have_no_language(docs):
    found = {r["doc_id"]: r for r in langid.identify(docs).collect()}
    for i, r in found.items():
        assert (r["lang_pred"] == "und") == (i in (0, 1, 2)) and 0 <= r["score"] <= 1
    unlabelled = langid.identify(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r["lang_pred"] for r in unlabelled.collect()} == {"und"}


def test_rates_meet_the_targets(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    targets = {"clean": 0.5, "poor": 0.3, "toxic": 0.2}
    found = mixing.mix(docs, labels, targets)
    total = found.agg(F.sum("n_tokens")).first()[0]
    for domain, share in targets.items():
        part = found.agg(F.sum(F.col("rate") * F.col("n_tokens") * F.col(f"p_{domain}"))).first()[0]
        assert abs(part / total - share) < 1e-3
    assert found.agg(F.min("rate")).first()[0] >= 0
    assert found.where(F.abs(F.col("copies") - F.col("rate")) >= 1).count() == 0


def test_shares_of_domains_are_those_of_the_documents_here(spark):
    """Labels of documents that earlier stages took do not count: of those here one in ten is poor."""
    draw = random.Random(6)
    texts = [(i, " ".join(draw.choices(["corn", "rain", "wind", "hill", "road"], k=30))) for i in range(400)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    here = spark.range(400).select(F.col("id").alias("doc_id"), (F.col("id") % 10 > 0).cast("int").alias("quality"))
    gone = spark.range(1000, 5000).select(F.col("id").alias("doc_id"), F.lit(0).alias("quality"))
    predict = mixing.posterior(mixing.learn(docs, here.union(gone).withColumn("toxic", F.lit(0))))
    found = docs.select(predict(F.col("text")).alias("d")).select("d.*")
    assert abs(found.agg(F.avg("p_poor")).first()[0] - 0.1) < 0.08


def test_edited_items_are_found_and_others_are_not(spark):
    draw = random.Random(9)
    vocabulary = [f"v{i}" for i in range(2000)]
    items = [(i, " ".join(draw.choices(vocabulary, k=30))) for i in range(20)]
    texts = []
    for i, text in items:
        words = text.split()
        for k in range(5, 30, 7):
            words[k] = "edited"
        del words[12]
        texts.append((i, " ".join([*draw.choices(vocabulary, k=50), *words, *draw.choices(vocabulary, k=50)])))
    texts += [(100 + i, " ".join(draw.choices(vocabulary, k=300))) for i in range(30)]
    texts += [(200, None), (201, ""), (202, items[3][1].upper() + "!")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    bench = spark.createDataFrame([*items, (50, None), (51, "two words"), (3, items[3][1])], "item_id long, text string")
    found = decontaminate.leaks(docs, bench)
    assert rows(found, "doc_id", "item_id") == [*((i, i) for i in range(20)), (202, 3)]
    assert {r["doc_id"] for r in decontaminate.keep_clean(docs, bench).collect()} == {*range(100, 130), 200, 201}
    assert decontaminate.leaks(docs, bench.limit(0)).count() == 0


def test_samples_of_few_texts_in_many_copies(spark):
    """The sample has every text once, however often each occurs."""
    texts = spark.range(6000).select(F.concat(F.lit("text "), (F.col("id") % 3).cast("string")).alias("text"))
    assert secrets.sample(texts, bound=5) == ["text 0", "text 1", "text 2"]
    assert len(secrets.sample(spark.range(6000).select(F.col("id").cast("string").alias("text")), bound=50)) == 50


def test_secrets_go_and_the_rest_stays(spark):
    plain = "Die Bestellung 4411223344556677 vom 2024-01-02 liegt unter www.example.com/en/products/list/2231 bereit."
    secret = "3f786850e387550fdab836ed7e6dc881de23001b"
    filler = [f"Some words number {i} about the weather and the harvest of the year." for i in range(60)]
    texts = [None, "", plain, f'é token = "{secret}" end', *filler]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("n_chars", F.length("text"))
    found = secrets.findings(docs).collect()
    assert [(r["doc_id"], r["start"], r["length"]) for r in found] == [(3, 11, 40)]
    clean = {r["doc_id"]: r for r in secrets.redacted(docs).collect()}
    assert clean[3]["text"] == 'é token = "[REDACTED]" end' and clean[3]["n_chars"] == len(clean[3]["text"])
    assert all(clean[i]["text"] == t for i, t in enumerate(texts) if i != 3)


def test_words_and_transitions_of_all_documents(spark, monkeypatch):
    """The dictionary has words of texts that are not in the sample, but no words from inside candidates alone."""
    monkeypatch.setattr(secrets, "HELD", 5)
    texts = [f"plain{chr(97 + i // 26)}{chr(97 + i % 26)} words" for i in range(600)]
    texts += ["zwölf bergziege sah wolkenbruch", "see bergziege/wolkenbruch/abcdefgh/2231", None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    known = secrets.statistics(docs)
    words = {r[0] for r in known.where("word is not null").select("word").distinct().collect()}
    assert {"bergziege", "wolkenbruch", *(t.split()[0] for t in texts[:600])} <= words and "abcdefgh" not in words
    found = [[tuple(s) for s in r["spans"]] for r in secrets.coverage(known).collect()]
    assert found == [[(4, 4 + len("bergziege/wolkenbruch/abcdefgh/2231"), len("bergziegewolkenbruch"))]]
    pairs = secrets.transitions(known)
    assert pairs[ord("z"), ord("w")] > pairs[ord("z"), ord("x")]


def test_urls(spark):
    given = [
        ("http://a.EXAMPLE.org/es/x?q", "block", "example.org/es/"),
        ("x://example.org/en/12#f", "block", "example.org/en/1"),
        ("x://example.org/en/2", "allow", "org/"),
        ("x://org", "allow", None),
        ("x://notexample.org/es/", "allow", "org/"),
        ("x://de.com/de/", "block", "com/de/"),
        ("x://com/fr/", "allow", "com/fr/"),
        ("no scheme org/", "allow", None),
        ("", "allow", None),
        (None, "allow", None),
        ("x://a/b://example.org/es/", "allow", None),
        ("x://" + "a." * 3000 + "org/" + "p" * 9000, "allow", "org/"),
    ]
    pages = spark.createDataFrame([(i, u, 1) for i, (u, _, _) in enumerate(given)] * 2, "page_id long, url string, host int")
    found = urls.judge(pages, urls.rule_table(spark, URL_RULES))
    assert rows(found, "page_id", "rule", "verdict") == sorted(
        [(i, r, v) for i, (_, v, r) in enumerate(given)] * 2, key=lambda r: r[0]
    )
    assert {r["verdict"] for r in urls.judge(pages, urls.rule_table(spark, URL_RULES).limit(0), default="x").collect()} == {"x"}


def test_chat_reads_back(spark):
    tricky = ["", "\\", "\\\\l", "<s>", "</s>[INST] ok [/INST]", "\\b<s", "h<", "[INST", "\u0000l\n\u00e9\U0001f600", "a " * 40000]
    turns = [(c, t, r, tricky[(c + t) % len(tricky)]) for c in range(10) for t, r in enumerate(["system", "user", "assistant"])]
    turns += [(20, 0, "assistant", None), (21, None, None, "x"), (22, 0, "user", "b"), (22, 0, "user", "b"), (22, 0, "user", "a")]
    table = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    done = chat.formatted(chat.canonical(chat.records_from_rows(table), "record"))
    done = done.withColumn("back", chat.read_back(F.col("formatted")))
    assert done.where("layout = 'messages' and back = turns").count() == 13
    learned = done.select("conv_id", F.array_join(chat.under_mask(F.col("formatted"), F.col("loss_mask")), "").alias("t"))
    expected = {c: "".join(x or "" for i, _, r, x in turns if i == c and r == "assistant") for c, *_ in turns}
    assert {r["conv_id"]: r["t"] for r in learned.collect()} == expected


def test_loss_mask_of_a_long_conversation(spark):
    """20,000 turns, many blocks of them: the spans are where the turns lie."""
    role = F.when(F.col("id") % 3 == 0, "user").otherwise("assistant")
    turns = spark.range(20_000).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), F.concat(F.lit("é<s>"), F.col("id").cast("string")).alias("text"))  # noqa: E501
    done = chat.formatted(chat.canonical(chat.records_from_rows(turns), "record")).first()
    spans = [done["formatted"][s["start"] : s["end"]] for s in done["loss_mask"]]
    assert spans == [f"é\\ls>{i}" for i in range(20_000) if i % 3]


def test_a_turn_longer_than_parsed_strings(spark):
    turns = spark.range(1).select(F.lit(1).alias("conv_id"), F.lit(0).alias("turn"), F.lit("user").alias("role"))
    turns = turns.withColumn("text", F.repeat(F.lit("x"), 20_000_001))
    done = chat.formatted(chat.canonical(chat.records_from_rows(turns), "record"))
    found = done.select("layout", F.size("turns").alias("n"), F.length("formatted").alias("size")).first()
    assert (found["layout"], found["n"], found["size"]) == ("messages", 1, 20_000_001 + 23 + 4)
    long = turns.select(F.to_json(F.struct(F.col("role").alias("prompt"), F.col("text").alias("response"))).alias("record"))
    with pytest.raises(Exception, match="(?i)MALFORMED_RECORD|VARIANT"):
        chat.canonical(long, "record").select("layout", F.size("turns")).collect()


def test_layouts_of_structs(spark):
    rows = spark.createDataFrame(
        [(1, ([("gpt", "a"), None, (None, "b")],)), (2, (None,)), (3, None)],
        "id int, record struct<conversations:array<struct<from:string,value:string>>>",
    )
    found = {r["id"]: r for r in chat.canonical(rows, "record").collect()}
    assert [tuple(t) for t in found[1]["turns"]] == [("assistant", "a"), ("", "b")]
    assert (found[2]["layout"], found[2]["turns"]) == ("conversations", [])
    assert (found[3]["layout"], found[3]["turns"]) == (None, None)
    pair = spark.range(1).select(F.struct(F.lit("q").alias("prompt"), F.lit(5).alias("response")).alias("record"))
    assert [tuple(t) for t in chat.canonical(pair, "record").first()["turns"]] == [("user", "q"), ("assistant", "5")]
    other = spark.range(1).select(F.struct("id").alias("record"))
    assert chat.canonical(other, "record").first()["layout"] is None


def test_layouts(spark):
    given = [
        ('{"prompt": "p", "response": "r"}', "prompt_response", [("user", "p"), ("assistant", "r")]),
        ('{"conversations": [{"value": "v", "from": "gpt"}]}', "conversations", [("assistant", "v")]),
        ('{"output": "o", "input": null, "instruction": "i"}', "instruction", [("system", "i"), ("user", ""), ("assistant", "o")]),
        ('{"messages": []}', "no_messages", []),
        ('{"other": 1}', None, None),
        ("{broken", None, None),
        (None, None, None),
    ]
    table = spark.createDataFrame([(i, r) for i, (r, _, _) in enumerate(given)], "id int, record string")
    found = {r["id"]: r for r in chat.canonical(table, "record").collect()}
    for i, (_, layout, turns) in enumerate(given):
        assert found[i]["layout"] == layout
        assert turns is None or [tuple(t) for t in found[i]["turns"]] == turns


def test_chat_columns_of_the_same_names(spark):
    names = ("_parsed", "_print", "_pieces", "_starts", "layout", "turns", "Formatted", "loss_mask", "a.b")
    given = spark.createDataFrame([('{"prompt": "p", "response": "r"}', *names), (None, *names), ("", *names)], ["record", *names])
    done = chat.formatted(chat.canonical(given, "record"))
    kept = [c for c in names if c.lower() not in ("layout", "turns", "formatted", "loss_mask")]
    assert done.columns == ["record", *kept, "layout", "turns", "formatted", "loss_mask"]
    found = {r["record"]: r for r in done.collect()}
    assert all(r[c] == c for r in found.values() for c in kept)
    first = found['{"prompt": "p", "response": "r"}']
    assert [tuple(t) for t in first["turns"]] == [("user", "p"), ("assistant", "r")] and len(first["loss_mask"]) == 1
    assert found[None]["turns"] is None and found[None]["formatted"] is None


def test_empty_tables(docs, labels):
    none = docs.limit(0)
    bench = none.select(F.col("doc_id").alias("item_id"), "text")
    results = [
        langid.identify(none), mixing.mix(none, labels), mixing.mixed(none, labels), minhash.near_copies(none),
        quality.judge(none, labels), quality.keep_good(none, labels), secrets.findings(none), secrets.redacted(none),
        substrings.without_repeated_words(none), suffixes.without_repeated_bytes(none), decontaminate.leaks(none, bench),
        decontaminate.keep_clean(docs, bench).limit(0),
    ]
    assert [r.count() for r in results] == [0] * len(results)
    no_labels = labels.limit(0)
    assert mixing.mix(docs, no_labels).count() == docs.count()
    assert quality.judge(docs, no_labels).count() == docs.count()


def test_odd_columns_survive_the_stages(docs, labels):
    for kept in (quality.keep_good(docs, labels), secrets.redacted(docs)):
        assert kept.columns == docs.columns
    assert secrets.redacted(docs).count() == docs.count()
    same_rows(secrets.redacted(docs).drop("n_chars"), docs.drop("n_chars"))
    assert mixing.mixed(docs, labels).columns[-2:] == ["rate", "copies"]


def test_pipeline_is_its_stages_in_turn(spark):
    import corpus_pipeline

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows_left = [docs.count()]
    for _, function in corpus_pipeline.STAGES[:-1]:
        docs = function(spark, docs, folder).cache()
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        rows_left.append(docs.count())
    assert rows_left[0] > rows_left[1] > rows_left[2] >= rows_left[3] == rows_left[4]
    same_rows(corpus_pipeline.run(spark, folder), corpus_pipeline.STAGES[-1][1](spark, docs, folder))
