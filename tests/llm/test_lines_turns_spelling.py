"""Line dedup, conversation repair and spelling variants on small tables, against brute force."""

import hashlib
import heapq
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tablewright.llm import lines, spelling, turns
from tablewright.llm.catalog import damaged_conversations, slips
from tests.helpers import rows

SPACE = " \t\n\x0b\x0c\r"
ASCII_LOWER = {i: i + 32 for i in range(65, 91)}


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def in_order(found):
    return sorted(found, key=lambda r: [(v is None, v) for v in r])


# --- lines --------------------------------------------------------------------------


def line_corpus():
    draw = random.Random(3)
    common = ["This line is in many documents", "\tthis LINE is in many documents \r", "short", "É" * 20, "é" * 20, "x" * 19]
    texts = [None, "", "\n", "\n\n", " \t", "one line"]
    for _ in range(40):
        own = [f"line {draw.random()} of its own, long enough" for _ in range(draw.randint(0, 4))]
        found = own + [draw.choice(common) for _ in range(draw.randint(0, 5))]
        draw.shuffle(found)
        texts.append("\n".join(found) + draw.choice(["", "\n"]))
    texts.append("\n".join(draw.choice([*common, f"{i} " * 10]) for i in range(20_000)))
    found = [(i, t, "x", "y", 7) for i, t in enumerate(texts)]
    # Rows that repeat an id, with their own and with another text, and rows without one.
    return [*found, found[10], (11, texts[12], None, None, None), (None, texts[13], None, None, None), (None, None, None, None, None)]


def expected_lines(corpus, min_documents):
    key = lambda line: line.strip(SPACE).translate(ASCII_LOWER)
    held = defaultdict(set)
    for doc, text, *_ in corpus:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 20:
                held[key(line)].add(doc)
    last = {k: max((d for d in ds if d is not None), default=None) for k, ds in held.items() if len(ds) >= min_documents}
    for doc, text, *_ in corpus:
        found = (text or "").split("\n")
        kept = [line for line in found if key(line) not in last or last[key(line)] == doc]
        yield doc, len(found), len(found) - len(kept), "\n".join(kept), sha("\n".join(kept))


@pytest.mark.parametrize("min_documents", [3, 1])
@pytest.mark.parametrize("small", [True, False])
def test_common_lines(spark, monkeypatch, min_documents, small):
    if not small:
        monkeypatch.setattr("tablewright.operators.sizing.fits_broadcast", lambda df, limit=0: False)
    corpus = line_corpus()
    docs = spark.createDataFrame(corpus, "doc_id long, text string, h1 string, places string, n_lines long").repartition(5)
    found = lines.without_common_lines(docs, min_documents=min_documents)
    columns = ("doc_id", "n_lines", "n_dropped", "kept_text", "kept_sha256")
    assert rows(found, *columns) == in_order(expected_lines(corpus, min_documents))


def test_lines_of_no_documents(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert lines.without_common_lines(docs).count() == 0


def test_common_lines_are_counted_without_texts(spark):
    """What is shuffled to count lines are hashes and ids."""
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    counted = lines.common_lines(lines.hashed_lines(docs, "doc_id", "text"))
    exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", counted._jdf.queryExecution().toString())
    assert exchanges and not any("text" in e or "line#" in e for e in exchanges)


# --- conversations --------------------------------------------------------------------


def cheapest(found):
    """Edits of a conversation by searching all of them, cheapest and then least first."""
    after = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    best = [(0, "", 0, "", ())]
    done = set()
    while best:
        cost, audit, i, state, kept = heapq.heappop(best)
        if i == len(found) and state in ("", "a"):
            return cost, audit, kept
        if (i, state) in done:
            continue
        done.add((i, state))
        push = lambda *x: heapq.heappush(best, x)
        for name in ("user", "assistant"):
            if name[0] in after[state]:
                push(cost + 5, audit + "I", i, name[0], (*kept, (name, "")))
        if i < len(found):
            role, text, fault = found[i]
            push(cost + 2, audit + "D", i + 1, state, kept)
            extra = 5 if fault == "truncated" else 0
            if fault in ("truncated", ""):
                if role[:1] in after[state]:
                    push(cost + extra, audit + "K", i + 1, role[0], (*kept, (role, text)))
                for name in ("user", "assistant"):
                    if name[0] in after[state]:
                        push(cost + extra + 1, audit + "R", i + 1, name[0], (*kept, (name, text)))


def expected_report(given, conversations):
    by_conversation = {c: [] for c in conversations}
    for conv, turn, role, text, tie in given:
        role, text = (" " if v is None else v for v in (role, text))
        by_conversation.setdefault(conv, []).append((turn is not None, turn or 0, role, tie, turn, text))
    for conv, found in by_conversation.items():
        found.sort(key=lambda r: r[:4])
        seen, faults, coded = set(), Counter(), []
        for _, _, role, _, _, text in found:
            end = text.rstrip(SPACE)
            fault = "" if end[-1:] in tuple(".!?") else "truncated"
            fault = "blank" if not end else "duplicate" if (role, text) in seen else fault
            seen.add((role, text))
            faults[fault] += 1
            coded.append((role, text, fault))
        numbers = [r[4] for r in found if r[4] is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        roles = [r[2][:1] for r in found]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(roles, roles[1:]))
        cost, audit, kept = cheapest(coded)
        repaired = "\n".join(f"{role}:{text}" for role, text in kept)
        counts = (faults["blank"], faults["duplicate"], faults["truncated"])
        yield (conv, gaps, *counts, illegal, cost, audit, sha(repaired))


TURNS = "conv_id long, turn long, role string, text string, part int, h1 string, n string"


def some_turns(draw, conv, n):
    roles = ["system", "user", "user", "assistant", "assistant", "tool", "", None, "User"]
    texts = ["Yes.", "No!", "Why?", "cut off", "", " \n", None, "Done. \n", "é", "x "]
    found = []
    for i in range(n):
        text = draw.choice(texts) if draw.random() < 0.4 else f"Text {draw.randint(0, 10**6)}{draw.choice('.!?,')}"
        turn = None if draw.random() < 0.03 else i // 2 if draw.random() < 0.2 else i
        found.append((conv, turn, draw.choice(roles), text))
        found += [found[-1]] * (draw.randint(1, 3) if draw.random() < 0.1 else 0)
    return found


@pytest.fixture(scope="module")
def conversations(spark):
    draw = random.Random(8)
    given = [r for conv in range(150) for r in some_turns(draw, conv, draw.randint(1, 14))]
    given += some_turns(draw, 1000, 700) + some_turns(draw, None, 20)
    given += [(2000, None, None, None), (2000, None, "user", "Hi."), (3000, 5, "user", "Same.")] + [(3001, 1, "user", "Hm.")] * 40
    return spark.createDataFrame([(*r, 1, "a", "b") for r in given], TURNS).repartition(4).cache()


def with_ties(df):
    """Rows with what decides between rows of one turn and role."""
    h = turns._hashes(F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" ")))
    found = df.select("conv_id", "turn", "role", "text", F.struct(*h).alias("tie")).collect()
    return [(r[0], r[1], r[2], r[3], tuple(r[4])) for r in found]


def test_reports(spark, conversations):
    more = spark.createDataFrame([(1, "x"), (7777, "x"), (None, "y")], "conv_id long, turn string")
    found = turns.report(conversations, more)
    expected = in_order(expected_report(with_ties(conversations), [7777, None]))
    assert rows(found) == expected
    lost = [r for r in expected if r[0] == 7777]
    assert lost == [(7777, 0, 0, 0, 0, 0, 0, "", sha(""))]


def test_edits_lead_to_what_is_reported(conversations):
    edits = turns.edited(conversations).where("conv_id = 1000").orderBy("position").collect()
    told = turns.report(conversations).where("conv_id = 1000").first()
    assert "".join(r["edit"] for r in edits) == told["audit"]
    left = "\n".join(f"{r['role']}:{r['text']}" for r in edits if r["edit"] != "D")
    assert sha(left) == told["repaired_sha256"]
    assert [r["position"] for r in edits] == list(range(len(edits)))


def test_checkpoints_grow_with_the_square_root():
    for n in (0, 1, 2, 10, 1000, 100_000):
        held = turns._Checkpoints(None)
        for i in range(n):
            held.add("usa"[i % 3], turns.FINE)
        assert len(held.kept) == n // held.every and len(held.kept) ** 2 <= 6 * n + 4 and held.every**2 <= 2 * n + 1


def test_damage(spark):
    import zlib

    given = [(c, t, "assistant", "One. Two!") for c in range(40) for t in range(5)] + [(None, None, None, None)]
    df = spark.createDataFrame(given, "conv_id long, turn long, role string, text string")
    expected = []
    for conv, turn, role, text in given:
        name = lambda v: " " if v is None else str(v)
        kind = zlib.crc32(f"{name(conv)}:{name(turn)}".encode()) % 20
        text = {1: "", 2: re.sub("[.!?]", "", text or " ")}.get(kind, text or " ")
        row = (conv, turn, "user" if kind == 4 else role or " ", text)
        expected += [row] * {0: 0, 3: 2}.get(kind, 1)
    assert rows(damaged_conversations(df)) == in_order(expected)


def test_no_conversations(spark):
    none = spark.createDataFrame([], TURNS)
    assert turns.report(none).count() == turns.report(none, none).count() == turns.edited(none).count() == 0


# --- spelling -------------------------------------------------------------------------


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    a, b = sorted((a, b), key=len)
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def expected_variants(words, lead=5):
    near = {w: sorted((v for v in words if one_edit(w, v)), key=lambda v: (-words[v], v)) for w in words}
    form = {w: vs[0] for w, vs in near.items() if vs and words[vs[0]] >= lead * words[w]}
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        yield w, form.get(w), root, n, len(near[w]), words[form[w]] if w in form else None


def some_words(draw, n):
    stems = ["abcdef", "abcdeg", "aaaaaaaa", "ünlükäß", "zzzzzzzzzzzzzz", "wordlike", "x" * 300, "abc𝔘def"]
    words = set(stems)
    while len(words) < n:
        w = list(draw.choice(sorted(words)))
        at = draw.randrange(len(w))
        w[at : at + draw.randint(0, 1)] = draw.choice(["", "a", "b", "é", "ÿ"])
        if len(w) >= 6:
            words.add("".join(w))
    return {w: draw.choice([5, 6, 30, 30, 200, 1000, 5000, 10**12]) for w in sorted(words)}


@pytest.mark.parametrize("tile", [4096, 7])
def test_variants(spark, monkeypatch, tile):
    """In one tile per group, and with groups dealt to pairs of blocks."""
    monkeypatch.setattr(spelling, "TILE_ROWS", tile)
    words = some_words(random.Random(tile), 400)
    df = spark.createDataFrame(list(words.items()), "word string, n long").repartition(3)
    assert rows(spelling.variants(df)) == in_order(expected_variants(words))


def test_long_chains_of_forms(spark):
    words = {"aaaaaa" + "b" * i: 5 ** (27 - i) for i in range(26)}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    assert rows(spelling.variants(df)) == in_order(expected_variants(words))


@pytest.mark.parametrize("cells", [1, 500, 1 << 22])
def test_tiles_across_batches(spark, monkeypatch, cells):
    """Batches may end within a tile."""
    monkeypatch.setattr(spelling, "CELLS", cells)
    words = some_words(random.Random(5), 150)
    df = spelling.tiles(spelling.grouped(spark.createDataFrame(list(words.items()), "word string, n long"), 6))
    tile = ["m", "part", "g", "low", "high"]
    table = df.select(*tile, "longer", "block", "word", "n").orderBy(*tile, "longer", "block").toArrow()
    sums = Counter()
    for batch in spelling._compare(iter(table.to_batches(max_chunksize=13))):
        for w, n in zip(batch["word"].to_pylist(), batch["n_near"].to_pylist()):
            sums[w] += n
    assert sums == Counter({w: sum(one_edit(w, v) for v in words) for w in words if any(one_edit(w, v) for v in words)})


def test_words_of_texts(spark, monkeypatch):
    draw = random.Random(6)
    vocabulary = ["Kontext", "Größe", "größer", "ÉCLAIRS", "façade", "naïveté", "short", "a×b÷cdef", "Łódź", "straßen"]
    join = lambda n: "".join(draw.choice(vocabulary) + draw.choice(" -_.1\n,") for _ in range(n))
    corpus = [(i, join(draw.randint(0, 40)), "w") for i in range(60)] + [(None, join(30), "w"), (3, None, None), (4, "", None)]
    corpus += [corpus[5]] * 3 + [(77, join(5000), "w")]
    docs = spark.createDataFrame(corpus, "doc_id long, text string, word string").repartition(4)
    for edit in (None, slips):
        expected = Counter()
        for doc, text, _ in corpus:
            found = re.findall("[A-Za-zÀ-ÿ]+", text or "")
            changed = edit("" if doc is None else str(doc)) if edit else lambda w: w
            expected.update(changed(w.translate(ASCII_LOWER)) for w in found)
        kept = {(w, n) for w, n in expected.items() if len(w) >= 6 and n >= 5}
        assert set(rows(spelling.count_words(docs, edit=edit))) == kept and kept


def test_pieces_are_cut_between_words(monkeypatch):
    monkeypatch.setattr(spelling, "PIECE", 10)
    text = "Abcdefghijklm nop QRSTUVWXYZé-é" * 5 + "x" * 50
    found = list(spelling.pieces(text))
    assert "".join(found) == text.translate(ASCII_LOWER) and len(found) > 3
    assert [w for p in found for w in re.findall("[a-zé]+", p)] == re.findall("[a-zé]+", text.translate(ASCII_LOWER))


def test_slips_are_what_the_checksum_says():
    import zlib

    n = 0
    for doc in range(3000):
        h = zlib.crc32(f"{doc}:größer".encode())
        expected = "größer"
        if h % 199 == 0:
            at, n = h % 6, n + 1
            expected = expected[:at] + expected[at + 1 :]
        assert slips(str(doc))("größer") == expected
    assert n


def test_no_words(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    words = spelling.count_words(docs)
    assert words.count() == 0 and spelling.variants(words).count() == 0
