"""Parts of the operators against plain versions; most need no session."""

import itertools
import json
import math
import random
import re
from fractions import Fraction
from types import SimpleNamespace

import brute
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.llm import chat, common, decontaminate, lattice_lm, near_dup, packing, pii, quality_rules, site_bayes
from strata.llm.shingles import Shingler

# --- decontamination -------------------------------------------------------------


@settings(max_examples=150, deadline=None)
@given(st.text("abc ", min_size=1, max_size=12), st.text("abc ", max_size=40))
def test_myers_equals_the_plain_recurrence(item, text):
    got = decontaminate.best_match(decontaminate.masks(item), len(item), text, len(item))
    assert got[0] == brute.distance_inside(item, text)


@settings(max_examples=100, deadline=None)
@given(st.integers(0, 10**6), st.integers(0, 6))
def test_every_occurrence_within_the_budget_is_found(seed, edits):
    r = random.Random(seed)
    item = "".join(r.choice("abcdefgh") for _ in range(100))
    spoiled = list(item)
    for _ in range(edits):
        at = r.randrange(len(spoiled))
        spoiled[at : at + 1] = r.choice([[], ["z"], [spoiled[at], "z"]])
    text = "".join(r.choice("abcdefgh") for _ in range(300))
    found = decontaminate.Matcher([(1, item)], 0.07).matches(text + "".join(spoiled) + text)["items"]
    assert found and found[0]["distance"] <= edits


def test_pieces_cover_the_item():
    for n, k in ((1, 0), (5, 9), (100, 7)):
        item = "x" * n
        assert "".join(p for _, p in decontaminate.pieces(item, k)) == item


def test_items_without_an_edit_budget_match_whole_words():
    find = lambda item, text: [(x["distance"], x["end"]) for x in decontaminate.Matcher([(1, item)], 0.08).matches(text)["items"]]
    assert find("an", "a banana and an ant") == [(0, 15)] and find("an", "banana and") == [] and find("an", "An") == [(0, 2)]
    assert find("a a", "ba a ab a a") == [(0, 11)]
    # From 13 characters on one edit is allowed, so that words may be cut.
    assert find("thirteen char", "xthirteen charx") == [(0, 14)]


def test_shards_give_the_same_matches_one_after_another(spark, monkeypatch):
    r = random.Random(12)
    items = [(k if k % 4 else None, " ".join(r.choices("abcdefgh", k=12))) for k in range(40)]
    texts = [" ".join([items[r.randrange(40)][1], *r.choices("abcdefgh", k=5), items[r.randrange(40)][1]]) for _ in range(30)] + [None, "", "x"]
    docs = spark.createDataFrame([(k % 29, t) for k, t in enumerate([*texts, *texts[:9]])], "doc_id long, text string").repartition(4)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    steps = []
    own = decontaminate._find
    monkeypatch.setattr(decontaminate, "_find", lambda d, *a: steps.append(d._jdf.queryExecution().toString().count("MapInArrow")) or own(d, *a))
    key = lambda rows: sorted(map(repr, rows))
    whole = [key(f(docs, benchmark).collect()) for f in (decontaminate.leaks, decontaminate.drop_leaks)]
    assert whole[0] and len(whole[1]) == 3 and len(steps) == 2
    got = [key(f(docs, benchmark, shard_chars=300).collect()) for f in (decontaminate.leaks, decontaminate.drop_leaks)]
    assert got == whole
    plain, parts = (decontaminate.add_matches(docs, benchmark, shard_chars=c, unnamed=True)[0] for c in (10**6, 300))
    assert key(plain.collect()) == key(parts.collect())
    assert len(steps) > 12 and not any(steps)  # however many shards, each is one Python step over the documents


# --- near-dedup ------------------------------------------------------------------


@pytest.mark.parametrize("share", [0.5, 0.85])
@pytest.mark.parametrize("n", [12, 300])
def test_superminhash_estimates_similarity(share, n):
    r = np.random.default_rng(n)
    errors = []
    for _ in range(60):
        both = max(int(round(2 * n * share / (1 + share))), 1)
        x = r.integers(0, 2**63, 2 * n - both, dtype=np.uint64)
        a, b = x[:n], x[n - both :]
        true = both / len(x)
        errors.append((near_dup.superminhash(a) == near_dup.superminhash(b)).mean() - true)
    # Never worse than independent hashes: sqrt(J (1 - J) / slots).
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 1.15 * (share * (1 - share) / near_dup.SLOTS) ** 0.5


def test_superminhash_does_not_depend_on_order_or_chunks(monkeypatch):
    x = np.random.default_rng(0).integers(0, 2**63, 5000, dtype=np.uint64)
    whole = near_dup.superminhash(x)
    monkeypatch.setattr(near_dup, "CHUNK", 97)
    assert (near_dup.superminhash(x[::-1].copy()) == whole).all()


def test_bands_rarely_miss_a_pair_at_the_threshold():
    for t in (0.8, 0.85):
        n, rows = near_dup.bands(t)
        assert n * rows <= near_dup.SLOTS and (1 - t**rows) ** n <= 2e-6
    assert near_dup.bands(0.85) == (24, 5) and near_dup.bands(0.8) == (30, 4)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abcd"), max_size=9), min_size=2, max_size=7))
def test_links_by_sets_are_exact(texts):
    shingler = Shingler(3)
    sets = [shingler.sorted_set(shingler.words(" ".join(t))) for t in texts]
    kept = [k for k, s in enumerate(sets) if len(s)]
    if len(kept) < 2:
        return
    got = {k: k for k in range(len(kept))}
    for a, b in near_dup.links_by_sets([sets[k] for k in kept], Fraction(85, 100)):
        got[b] = a
    expected = brute.components({i: " ".join(texts[k]) for i, k in enumerate(kept)}, 3, 85, 100)
    assert {i: got[i] for i in got} == {i: root for i, (_, root) in expected.items()}


def test_components_of_long_chains_and_stars(spark):
    key = lambda k: k.to_bytes(4, "big")
    pairs = [(k, k + 1) for k in range(200)] + [(1000, k) for k in range(1001, 1300)] + [(5000, 4000), (5000, 4500), (7, 7)]
    random.Random(1).shuffle(pairs)
    links = spark.createDataFrame([(key(a), key(b)) for a, b in pairs], "u binary, v binary")
    got = {int.from_bytes(r["node"], "big"): int.from_bytes(r["root"], "big") for r in near_dup.components(links, "test").collect()}
    assert got == {**{k: 0 for k in range(201)}, **{k: 1000 for k in range(1000, 1300)}, 4000: 4000, 4500: 4000, 5000: 4000}
    assert near_dup.components(links.limit(0), "test").count() == 0


def test_large_families_are_compared_in_blocks(spark, monkeypatch):
    """A chain of near copies longer than a block: only neighbours are similar, yet one component results."""
    monkeypatch.setattr(near_dup, "FAMILY_BLOCK", 8)
    monkeypatch.setattr(near_dup, "BUCKET_BLOCK", 8)
    r = random.Random(3)
    words = [f"w{r.randrange(10**6)}" for _ in range(120)]
    texts = {}
    for k in range(60):
        texts[k] = " ".join(words)
        words[r.randrange(len(words))] = f"w{r.randrange(10**6)}"
    texts |= {100: "quite another text of some words", 101: "quite another text of some words"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {row["doc"]: row["component"] for row in near_dup.find_components(docs, 3, Fraction(85, 100)).collect()}
    assert got == {i: root for i, (_, root) in brute.components(texts, 3, 85, 100).items()}


# --- packing ---------------------------------------------------------------------


def test_each_entry_of_the_vocabulary_is_rebuilt_by_its_merges():
    """The condition under which both byte-pair encoders agree on every text, see the module's docstring."""
    path = packing.vocabulary_path()
    ranks = packing.byte_tokens(path)
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    assert len(ranks) == len(model["vocab"]) and sorted(ranks.values()) == list(range(len(ranks)))
    by_id = {i: b for b, i in ranks.items()}
    merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
    vocab = model["vocab"]
    last = {}
    for k, (a, b) in enumerate(merges):
        joined = by_id[vocab[a]] + by_id[vocab[b]]
        assert joined not in last and ranks[joined] == 512 + k  # ids rise with the merges, one merge an entry
        last[joined] = (by_id[vocab[a]], by_id[vocab[b]])

    def run(token):
        """The last two parts of a token under the merges, lowest first; the mark of the end joins its byte at once."""
        parts = [bytes([c]) for c in token]
        if parts[-1] == b"\xff" and len(parts) > 1:
            parts[-2:] = [parts[-2] + b"\xff"]
        while len(parts) > 2:
            best = min((ranks[x + y], k) for k, (x, y) in enumerate(zip(parts, parts[1:])) if last.get(x + y) == (x, y))
            parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
        return tuple(parts)

    assert all(run(token) == pair for token, pair in last.items())


@settings(max_examples=200, deadline=None)
@given(st.text(st.one_of(st.sampled_from("aAbBe'sét ß.,#1½µ \n\t\x1c\xa0 ́Σİ한<|>"), st.characters(codec="utf-8")), max_size=40))
def test_encoder_equals_the_library(text):
    encode = _encoder()
    assert encode(text) == encode.by_library(text)


def _encoder(kept=[]):  # noqa: B006
    if not kept:
        kept.append(packing.Encoder(packing.vocabulary_path(), cached_words=50))
    return kept[0]


def test_special_tokens_in_a_text():
    for text in ("a <|endoftext|> b", "x<|startoftext|>", "<|endoftext|", "the<|ENDOFTEXT|>"):
        assert _encoder()(text) == _encoder().by_library(text)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(1, 300), st.integers(1, 9000)), max_size=120))
def test_bins_hold_each_token_once(lengths):
    bins, sequences = packing.HarmonicBins(), []
    for doc, n in enumerate(lengths):
        sequences += bins.add([doc, 0, n, n, np.arange(n, dtype="<u4").tobytes()])
    sequences += bins.close()
    seen = {}
    for pieces in sequences:
        assert sum(p[2] for p in pieces) <= packing.CAPACITY
        for doc, start, n, total, ids in pieces:
            assert np.frombuffer(ids, "<u4").tolist() == list(range(start, start + n)) and total == lengths[doc]
            seen.setdefault(doc, []).extend(range(start, start + n))
    assert {d: sorted(v) for d, v in seen.items()} == {d: list(range(n)) for d, n in enumerate(lengths)}
    used = [sum(p[2] for p in s) for s in sequences]
    padded = [u for u in used if u & (u - 1)]
    assert all(u >= packing.CAPACITY - packing.SLACK for u in padded)


def test_whole_documents_fill_a_bin_by_count():
    bins, sequences = packing.HarmonicBins(), []
    for doc in range(9):
        sequences += bins.add([doc, 0, 680, 680, bytes(4 * 680)])
    assert [[p[0] for p in s] for s in sequences] == [[0, 1, 2], [3, 4, 5], [6, 7, 8]]


# --- language model --------------------------------------------------------------


def _toy():
    pieces = {b" a": 0.2, b" ab": 0.1, b"b": 0.1, b"bc": 0.15, b" ": 0.05, b"abc": 0.1, b"c": 0.1, b"\xc3\xa9": 0.05}
    rest = {bytes([k]): 1e-4 for k in range(256) if bytes([k]) not in pieces}
    return {k: math.log(v) for k, v in (pieces | rest).items()}


def _segmentations(word, logs):
    for cuts in itertools.product((0, 1), repeat=len(word) - 1):
        ends = [k + 1 for k, c in enumerate(cuts) if c] + [len(word)]
        parts = [word[a:b] for a, b in zip([0, *ends], ends)]
        if all(p in logs for p in parts):
            yield parts


@pytest.mark.parametrize("word", [b" ", b" abc", b" abcabc", " é".encode(), " xéabcb".encode()])
def test_lattice_sums_all_segmentations(word, monkeypatch):
    logs = _toy()
    weights = {tuple(s): math.exp(sum(logs[p] for p in s)) for s in _segmentations(word, logs)}
    total = sum(weights.values())
    expected = {}
    for s, w in weights.items():
        for p in s:
            expected[p] = expected.get(p, 0.0) + 3 * w / total
    monkeypatch.setattr(lattice_lm, "TOGETHER", 1)
    lattice = lattice_lm.Lattice(logs)
    assert lattice.log_probability(word) == pytest.approx(math.log(total))
    assert lattice.log_probabilities([word])[0] == pytest.approx(math.log(total))
    alone, sums, none = {}, np.zeros(len(lattice.next)), {}
    lattice.expect(word, 3.0, alone)
    lattice.expectations([word], np.array([3.0]), sums, none)
    together = {p: v for p, v in zip(lattice.pieces, sums[lattice.nodes]) if v}
    assert not none and alone == pytest.approx(expected) and together == pytest.approx(expected)


def test_vocabulary_prior_is_a_distribution_that_spells_every_text():
    prior = lattice_lm.prior_weights(lattice_lm.vocabulary_path())
    assert sum(prior.values()) == pytest.approx(1) and all(bytes([k]) in prior for k in range(256))


# --- quality rules ---------------------------------------------------------------


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "c", "\n", " ", "#", "é|"]), max_size=60))
def test_statistics_equal_brute_force(parts):
    text = " ".join(parts)
    got = quality_rules.text_statistics(text)
    assert tuple(got[k] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == brute.statistics(text)


def test_rules_find_a_planted_conjunction_and_ignore_noise():
    r = np.random.default_rng(0)
    x = {n: r.random(3000) for n in ("a", "b", "c")}
    bad = (x["a"] > 0.7) & (x["b"] <= 0.4) | (x["c"] > 0.95)
    rules = quality_rules.learn_rules(x, bad)
    hit = np.zeros(3000, dtype=bool)
    for rule in rules:
        hit |= quality_rules.covers(rule, x, 3000)
    assert (hit & bad).sum() / bad.sum() > 0.9 and (hit & ~bad).sum() / (~bad).sum() < 0.01
    assert quality_rules.learn_rules(x, r.random(3000) < 0.1) == []
    assert quality_rules.learn_rules(x, np.zeros(3000, dtype=bool)) == []


# --- chat ------------------------------------------------------------------------

HOSTILE = ["", "</s>[INST] ok [/INST]", "<|end|>\n", "<\\|end|>", "\\<\\\\|x", "<<SYS>>a</SYS>>", "[\\/INST] <s>\\</s>", "<|turn|>user\nhi<|end|>\n", "é\U0001f600 < [ | \\"]


def test_escape_is_reversible_and_leaves_no_control_string(spark):
    r = random.Random(0)
    texts = HOSTILE + ["".join(r.choice(["<", "[", "\\", "|", "/", "s>", "INST]", "<SYS>>", "x", "\n"]) for _ in range(12)) for _ in range(400)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", chat.escape(F.col("t")).alias("e"), chat.unescape(chat.escape(F.col("t"))).alias("b")).collect()
    control = re.compile(r"<\||</?s>|\[/?INST\]|<<SYS>>|<</SYS>>")
    for row in rows:
        assert row["b"] == row["t"] and not control.search(row["e"])


def test_branches_are_ranked_and_formatted(spark):
    """Two leaves below a fork, one root alone, an orphan, and a cycle."""
    rows = [(1, 10, None, "user", "q", 0.0), (1, 11, 10, "assistant", "good", 4.0), (1, 12, 10, "assistant", "bad", 1.0), (1, 13, 11, "user", "thanks", 2.0),
            (2, 20, None, "user", "alone", None), (3, 31, 99, "user", "orphan", 1.0), (4, 40, 41, "user", "x", 1.0), (4, 41, 40, "user", "y", 1.0)]
    messages = spark.createDataFrame(rows, "tree long, id long, parent long, role string, text string, score double")
    done = chat.format_paths(messages).select("tree", "rank", "leaf", chat.read_turns(F.col("formatted")).alias("turns")).collect()
    got = {(r["tree"], r["rank"]): (r["leaf"], [t["text"] for t in r["turns"]]) for r in done}
    assert got == {(1, 1): (13, ["q", "good", "thanks"]), (1, 2): (12, ["q", "bad"]), (2, 1): (20, ["alone"]), (3, 1): (31, ["orphan"])}
    assert {(r["tree"], r["leaf"]) for r in chat.format_paths(messages, branches=1).collect()} == {(1, 13), (2, 20), (3, 31)}


def test_long_paths_take_few_rounds(spark):
    n = 300
    rows = [(1, k, k - 1 if k else None, "assistant" if k % 2 else "user", f"t{k}", 1.0) for k in range(n)]
    done = chat.format_paths(spark.createDataFrame(rows, "tree long, id long, parent long, role string, text string, score double")).first()
    assert done["n_turns"] == n and re.findall(r"\n(t\d+)<", done["formatted"]) == [f"t{k}" for k in range(n)]


def test_items_without_id_remove_their_documents(spark):
    docs = spark.createDataFrame([(1, "here is the secret question of the test"), (2, "nothing of that kind"), (3, "named item one in it")], "doc_id long, text string")
    items = spark.createDataFrame([(None, "the secret question"), (7, "named item one"), (None, "named item one")], "item_id long, text string")
    assert [r["doc_id"] for r in decontaminate.drop_leaks(docs, items).collect()] == [2]
    assert [(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(docs, items).collect()] == [(3, 7)]
    found, name = decontaminate.add_matches(docs, items, unnamed=True)
    assert {r["doc_id"]: [x["item_id"] for x in r[name]] for r in found.collect()} == {1: [None], 2: [], 3: [None, 7]}


def test_equal_turns_and_repeated_rows_stay_in_one_conversation(spark, tmp_path):
    from strata.llm.queries import queries

    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "b"), (1, 1, "assistant", "a"), (1, 2, None, "r"), (1, 2, None, "r"), (2, 5, "user", "x"), (2, 5, "user", "x"), (None, 0, "user", None)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r["conv_id"]: r for r in queries()["op2_reply_trees"](spark, str(tmp_path)).collect() if r["conv_id"] != -7}
    said = {1: ["user\nq\n", "assistant\na\n", "assistant\nb\n", "\nr\n", "\nr\n"], 2: ["user\nx\n"] * 2, None: ["user\n\n"]}
    assert {k: (r["n_turns"], r["turns_sha256"]) for k, r in got.items()} == {k: (len(v), brute.sha("".join(v))) for k, v in said.items()}
    assert got[1]["loss_sha256"] == brute.sha("ab") and got[1]["loss_chars"] == 2


# --- personal data ---------------------------------------------------------------

CARD = "4111 1111 1111 1111"


@pytest.mark.parametrize(
    "text, kind, hidden",
    [
        ("write to ann.lee [at] mail (dot) example.org now", "email", "ann.lee [at] mail (dot) example.org"),
        ("write to ann at mail dot example dot org now", "email", "ann at mail dot example dot org"),
        ("ann{ AT }mail.example.org", "email", "ann{ AT }mail.example.org"),
        ("аnn＠mаil．org", "email", "аnn＠mаil．org"),  # Cyrillic a, full-width signs
        ("see an​n@ma​il.org!", "email", "an​n@ma​il.org"),
        ("host １９２.168.0.７ up", "ip", "１９２.168.0.７"),
        ("pay ４１１１ 1111 1111 1111 ok", "card", "４１１１ 1111 1111 1111"),
        ("call plus four one five five five five zero one two three today", "phone", "plus four one five five five five zero one two three"),
        ("four one one one one one one one one one one one one one one one", "card", "four one one one one one one one one one one one one one one one"),
        ("call four-one-five, five five five, zero one two three", "phone", "four-one-five, five five five, zero one two three"),
    ],
)
def test_disguised_identifiers_map_back_to_the_source(text, kind, hidden):
    found = pii.find(text)
    assert any(s["kind"] == kind and text[s["start"] : s["end"]] == hidden for s in found["added"]), found


def test_the_prefilter_and_the_fold_agree_on_all_characters():
    characters = [chr(c) for c in range(128, 0x110000)]
    assert [c for c in characters if pii._suspect(c) != (pii._fold(c) is not None)] == []


@pytest.mark.parametrize("zero", "০௦๐០၀")  # Bengali, Tamil, Thai, Khmer, Myanmar
def test_digits_of_any_script(zero):
    written = CARD.translate({ord(str(d)): chr(ord(zero) + d) for d in range(10)})
    assert pii.find(f"pay {written} ok")["added"] == [{"kind": "card", "start": 4, "end": 4 + len(written)}]


SPOKEN = "four one five five five five zero one two three"


@pytest.mark.parametrize(
    "text, kind, hidden",
    [
        ("call four one five five five five 0123 now", "phone", ["four one five five five five 0123"]),
        (f"call {SPOKEN}, {SPOKEN} now", "phone", [SPOKEN] * 2),
        (f"{SPOKEN}\n{SPOKEN}\n{SPOKEN}", "phone", [SPOKEN] * 3),
        ("four-one-five, five five five, zero one two three, four-one-five, five five five, zero one two four", "phone", ["four-one-five, five five five, zero one two three", "four-one-five, five five five, zero one two four"]),
        (f"4155550123, {SPOKEN}", "phone", [SPOKEN]),
        (f"order 12345678 {SPOKEN}", "phone", [SPOKEN]),
        ("2024 four" + " one" * 15, "card", ["four" + " one" * 15]),
        ("at one nine two [dot] one six eight [dot] one [dot] one now", "ip", ["one nine two [dot] one six eight [dot] one [dot] one"]),
        ("at one nine two dot one six eight dot one dot one now", "ip", ["one nine two dot one six eight dot one dot one"]),
        ("at 192 dot 168 dot 1 dot 1 now", "ip", ["192 dot 168 dot 1 dot 1"]),
        ("at 192.168.one.1 now", "ip", ["192.168.one.1"]),
        ("four.one.five.five.five.five.zero.one.two.three", "phone", ["four.one.five.five.five.five.zero.one.two.three"]),
        ("plus one dot two one two dot two zero two dot one two three four", "phone", ["plus one dot two one two dot two zero two dot one two three four"]),
    ],
)
def test_spelled_digits_and_dots_in_all_shapes(text, kind, hidden):
    found = pii.find(text)
    assert [text[s["start"] : s["end"]] for s in found["added"] if s["kind"] == kind] == hidden, found


@pytest.mark.parametrize("text", ["one. two. three. four.", "1. 2. 3. 4. five. six. seven", "pages 12, 13, 14, 15 and two, three", "version three dot one", "one " * 20000])
def test_lists_and_endless_runs_are_no_identifiers(text):
    assert not pii.find(text)["added"]


@pytest.mark.parametrize(
    "text",
    ["He was at home. The dot on the map was red.", "one two three go", "Привет всем, мир", "naïve café à la carte, año", "(at) the end (see below)", "a point (.) here", "Look at example dot", "x" * 5000 + " " * 5000 + "at" + " " * 5000],
)
def test_ordinary_text_has_no_spans(text):
    assert pii.find(text) == {"base": [], "added": []}


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("ab1 2.@+-()＠．а​0 dot at one[]"), max_size=60))
def test_base_spans_stay(text):
    found = pii.find(text)
    assert [(s["kind"], s["start"], s["end"]) for s in found["base"]] == brute.base_spans(text)
    assert all(0 <= s["start"] < s["end"] <= len(text) for s in found["added"])


def test_luhn():
    assert pii.luhn(CARD.replace(" ", "")) and not pii.luhn("4111111111111112")


# --- sites -----------------------------------------------------------------------


def test_sparse_sites_stay_near_the_prior(spark):
    rows = [(f"h{k}", float(s), n) for k, (s, n) in enumerate([(50, 100), (2, 100), (90, 100), (8, 100), (1, 1), (60, 100)])]
    groups = spark.createDataFrame(rows, "host string, s double, n long")
    rate = sum(r[1] for r in rows) / sum(r[2] for r in rows)
    pull = site_bayes.strength(groups, "s", "n", F.lit(rate))
    assert 1 <= pull < 20  # the hosts differ much, so their own rates count much
    same = spark.createDataFrame([(f"h{k}", 10.0 + k % 3, 100) for k in range(30)], "host string, s double, n long")
    assert site_bayes.strength(same, "s", "n", F.lit(0.11)) > 1000  # no spread beyond chance


def test_calibration_is_a_probability():
    r = np.random.default_rng(1)
    score = r.normal(0, 300, 4000)
    y = (r.random(4000) < 1 / (1 + np.exp(-np.arcsinh(score)))).astype(float)
    a, b = site_bayes.calibrate(score, y)
    assert a == pytest.approx(1, abs=0.15) and b == pytest.approx(0, abs=0.2)
    assert site_bayes.calibrate(np.zeros(0), np.zeros(0)) == (0.0, 0.0)


def _recorder(path, to):
    def record(batch):
        import os

        with open(f"{path}/{to}-{os.getpid()}", "a") as f:
            f.write(f"{batch.nbytes}\n")
        return batch

    return record


def _recorded(path, to):
    return [int(n) for f in path.glob(f"{to}-*") for n in f.read_text().split()]


def test_texts_travel_in_small_batches(spark, monkeypatch, tmp_path):
    import pyarrow as pa

    docs = spark.range(0, 900, 1, 1).select(F.col("id").alias("doc_id"), F.concat(F.lit("w"), F.col("id").cast("string"), F.repeat(F.lit(" some words"), 1800)).alias("text"))

    def recording(record, rows):
        return lambda batches, rows=rows: (record(b).slice(at, rows) for b in batches for at in range(0, b.num_rows, rows))

    spark.conf.unset(common.BATCH_SETTING)
    try:
        for module, to, run in ((common, "rules", lambda: quality_rules.add_statistics(docs, "stats")), (near_dup, "near", lambda: near_dup.sketch(docs, 5))):
            monkeypatch.setattr(module, "slices", recording(_recorder(tmp_path, to), common.SLICE_ROWS))
            assert len(run().collect()) == 900
            sent = _recorded(tmp_path, to)
            assert sum(sent) > 16 * 2**20 and max(sent) < 2 * common.BATCH_BYTES
            spark.conf.unset(common.BATCH_SETTING)

        record = _recorder(tmp_path, "pieces")
        made = lambda arrays, names: record(pa.RecordBatch.from_arrays(arrays, names=names))
        monkeypatch.setattr(packing, "pa", SimpleNamespace(array=pa.array, int64=pa.int64, binary=pa.binary, RecordBatch=SimpleNamespace(from_arrays=made)))
        long = docs.select("doc_id", F.repeat("text", 20).alias("text")).limit(30)
        assert {r.doc_id: r.n for r in packing.pack(long).groupBy("doc_id").agg(F.sum("length").alias("n")).collect()} == {r.doc_id: r.n for r in packing.pack(long).select("doc_id", F.col("doc_tokens").alias("n")).distinct().collect()}
        sent = _recorded(tmp_path, "pieces")
        assert sum(sent) > 4 * 2**20 and max(sent) < 2 * packing.OUT_BYTES
    finally:
        spark.conf.unset(common.BATCH_SETTING)


def test_a_session_keeps_its_own_bound_of_batches(spark):
    spark.conf.set(common.BATCH_SETTING, "5m")
    try:
        near_dup.sketch(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), 5).collect()
        assert spark.conf.get(common.BATCH_SETTING) == "5m"
    finally:
        spark.conf.unset(common.BATCH_SETTING)


def test_words_kept_by_a_worker_are_few():
    encode, shingler = packing.Encoder(packing.vocabulary_path()), Shingler(5)
    for at in range(0, 120_000, 1000):
        words = [f"w{k}" for k in range(at, at + 1000)]
        encode(" ".join(words))
        shingler.sorted_set(shingler.words(" ".join(words)))
        assert max(len(encode.cache), len(shingler.cache)) <= 50_000
