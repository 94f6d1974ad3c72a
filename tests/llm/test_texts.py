"""Toxicity, seeds, quotations, pages, fingerprints and token counts."""

import itertools
import random

import numpy as np
import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from assetlake.llm import invertible_sketch, prefix_tokens, quotations, spaced_seeds, style_tree, toxicity

DOC = "doc_id long, text string"


# --- toxicity
@pytest.fixture(scope="module")
def toxic_world(spark):
    rng = random.Random(1)
    plain = "the garden was green and we walked along a quiet river before dinner with old friends".split()
    rude = ["loser", "idiot", "pathetic", "worthless"]
    docs, labels = [], []
    for i in range(600):
        words = [rng.choice(plain) for _ in range(rng.randrange(8, 40))]
        bad = i % 4 == 0
        if bad:
            words[rng.randrange(len(words))] = rng.choice(rude)
        docs.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    docs += [(1000, None), (1001, ""), (1002, "you are a l0ser"), (1003, "such an i d i o t indeed"), (1004, "patheeeeetic"), (1005, " \n")]
    frame = spark.createDataFrame(docs, DOC)
    marks = spark.createDataFrame(labels + [(5000, 1), (3, None), (None, 1)], "doc_id long, toxic int")
    costs = toxicity.language_model(toxicity.character_counts(frame))
    return frame, marks, costs


def test_held_out_toxicity(spark, toxic_world):
    docs, marks, _ = toxic_world
    got = toxicity.toxicity(docs.withColumn("_toxicity", F.lit("old")), marks).select("doc_id", "_toxicity", toxicity.held_out().alias("out"))
    rows = {r["doc_id"]: r for r in got.collect()}
    tested = [i for i in range(600) if rows[i]["out"]]
    right = [(rows[i]["_toxicity"] >= 0.5) == (i % 4 == 0) for i in tested]
    assert len(tested) > 60 and sum(right) >= 0.97 * len(right)
    assert all(rows[i]["_toxicity"] >= 0.5 for i in (1002, 1003, 1004))
    assert rows[1000]["_toxicity"] == rows[1001]["_toxicity"] == rows[1005]["_toxicity"] < 0.5


def test_restoring(toxic_world):
    reader = toxicity.Reader(toxic_world[2])
    assert reader.restored("an 1d10t and l0$er") == "an idiot and loser"
    assert reader.restored("p a t h e t i c!") == "pathetic!"
    assert reader.restored("worrrrrthless") == "worthless"
    plain = "The garden, 3 trees (green!) & 100$ of water."
    assert reader.restored(plain) == plain


def test_joined_clean_texts_stay_clean(spark, toxic_world):
    docs, marks, costs = toxic_world
    rng = random.Random(3)
    clean = [r["text"] for r in docs.where("doc_id < 600 and doc_id % 4 <> 0").collect()]
    rare = " ".join("".join(rng.choice("bcdfghaeou") for _ in range(rng.randrange(4, 11))) for _ in range(40_000))
    long = [(0, " ".join(clean)), (1, rare), (2, " ".join(clean) + " idiot " + " ".join(clean)), (3, " ".join(clean) + " l o s e r")]
    scores = toxicity.scored(spark.createDataFrame(long, DOC), costs, toxicity.learn(docs, marks, costs, F.lit(True)))
    assert {r["doc_id"]: r["_toxicity"] >= 0.5 for r in scores.collect()} == {0: False, 1: False, 2: True, 3: True}


def test_viterbi_finds_what_trying_every_path_finds(toxic_world):
    costs = toxic_world[2]
    decoder, rng = toxicity.Decoder(costs), random.Random(6)
    border = toxicity.BORDER

    def price(options, chosen):
        total, text = 0.0, ""
        for readings, k in zip(options, chosen, strict=True):
            total, text = total + readings[k][0], text + readings[k][1]
        codes = [border] * 3 + [int(toxicity.codes_of(c)[0]) for c in text + " "]
        for at in range(3, len(codes)):
            gram = ((codes[at - 3] * 28 + codes[at - 2]) * 28 + codes[at - 1]) * 28 + codes[at]
            total += float(costs[gram])
        return total, text

    for _ in range(40):
        signs = [rng.choice("l0s3r1d10t$@aab!") for _ in range(rng.randrange(2, 6))]
        options = [decoder.readings(c, rng.choice([1, 1, 2, 3]), rng.random() < 0.5) for c in signs]
        paths = itertools.product(*[range(len(o)) for o in options])
        found = [price(options, p) for p in paths]
        best = min(found)[0]
        assert decoder.best(options) in {text for total, text in found if total <= best + 1e-4}


def test_equal_rows_are_one_row_with_a_weight(spark, toxic_world, monkeypatch):
    docs, marks, costs = toxic_world
    many = docs.union(docs.where("doc_id = 8").withColumn("doc_id", F.explode(F.array_repeat("doc_id", 299))))
    kept = []
    monkeypatch.setattr(toxicity, "stored", lambda frame, name, put=toxicity.stored: kept.append((name, put(frame, name))) or kept[-1][1])
    weights, _ = toxicity.learn(many, marks, costs, F.lit(True), max_features=50)
    rows = dict(kept)["labelled"].where("first")
    assert rows.count() == 600 and rows.where("times = 300").count() == 1
    assert 0 < len(weights) <= 50 and {"idiot$", "loser$"} & set(weights)
    assert toxicity.learn(docs, marks, costs, F.lit(True), max_features=50)[0].keys() & {"idiot$", "loser$"}


def test_counts_of_four_signs(spark):
    texts = ["ab", "é!", None, "", "a  b", "x" * 70]
    got = toxicity.character_counts(spark.createDataFrame(enumerate(texts), DOC))
    letters = got.reshape(28, 28, 28, 28)
    a, b, x, e, other, border = 0, 1, 23, 4, toxicity.OTHER, toxicity.BORDER
    assert letters[border, border, border, a] == 2 and letters[border, border, a, b] == 1
    assert letters[border, border, e, other] == 1 and letters[x, x, x, x] == 67 and letters[a, border, border, b] == 1
    assert not letters[:, :, b, e].sum()  # no gram goes from one text to the next


def test_labels_of_one_kind_or_none(spark, toxic_world):
    docs = toxic_world[0].limit(5)
    none = toxicity.toxicity(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert all(r["_toxicity"] < 0.01 for r in none.collect())
    assert toxicity.toxicity(spark.createDataFrame([], DOC), toxic_world[1]).count() == 0


# --- spaced seeds
def test_overlaps_as_brute_force(spark):
    rng = random.Random(2)
    word = lambda: "w%d" % rng.randrange(400)
    items = [(i, [word() for _ in range(rng.choice([8, 14, 30]))]) for i in range(12)] + [(50, ["two", "words"])]
    docs = []
    for i in range(60):
        words = [word() for _ in range(80)]
        if i % 3 == 0:
            item = list(items[i % 12][1])
            for _ in range(rng.choice([0, 0, 1, 2]) if len(item) > 20 else 0):
                item[rng.randrange(len(item))] = "changed"
            at = rng.randrange(60)
            words[at : at + len(item)] = item
        docs.append((i, words))
    expected = set()
    for d, words in docs:
        for i, item in items:
            if len(item) < 6:
                continue
            for shift in range(1 - len(item), len(words)):
                equal = sum(0 <= shift + k < len(words) and words[shift + k] == t for k, t in enumerate(item))
                if equal >= 0.6 * len(item):
                    expected.add((d, i, equal))
    frame = spark.createDataFrame([(d, " ".join(w).title()) for d, w in docs] + [(90, None), (91, ""), (None, " ".join(items[0][1]))], DOC)
    tests = spark.createDataFrame([(i, ", ".join(w)) for i, w in items] + [(60, None), (61, "")], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"], r["equal"]) for r in spaced_seeds.overlaps(frame, tests).collect()}
    assert got == expected | {(None, 0, len(items[0][1]))}
    extra = frame.withColumn("item_id", F.lit(1))
    left = {r["doc_id"] for r in spaced_seeds.clean(extra, tests).collect()}
    assert left == {d for d, _ in docs} - {d for d, _, _ in expected} | {90, 91}
    assert spaced_seeds.overlaps(frame, tests.limit(0)).count() == 0
    assert spaced_seeds.overlaps(frame.limit(0), tests).count() == 0


# --- quotations
def test_quotations(spark):
    rows = [
        (1, 0, "user", "Hello there.\nHow are you?"), (1, 1, "assistant", "> How  are you?\nFine."),
        (1, 2, "user", "On Monday X wrote:\n> Fine.\n>> How are you?\nGood\nbye"),
        (1, 3, "assistant", "> Hello there.\n> How are you?\nback to the start"), (1, 4, "user", "continuing"),
        (1, 5, "user", "> > fine.\nnested only"), (2, 0, "user", None), (2, 1, "user", "> unknown words"), (None, None, None, "x"),
    ]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("thread", F.lit(0))
    got = quotations.reply_order(frame)
    assert rows_of(got, "conv_id", "turn", "text", "position", "reply_to", "linked", "quotes", "thread") == sorted([
        (1, 0, "Hello there.\nHow are you?", 0, None, False, 0, 0), (1, 1, "Fine.", 1, 0, True, 1, 0),
        (1, 2, "Good\nbye", 2, 1, True, 2, 0), (1, 3, "back to the start", 3, 0, True, 1, 3),
        (1, 4, "continuing", 4, 3, False, 0, 3), (1, 5, "nested only", 5, 1, True, 1, 5),
        (2, 0, "", 0, None, False, 0, 0), (2, 1, "", 1, 0, False, 1, 0), (None, None, "x", 0, None, False, 0, None),
    ], key=repr)
    assert quotations.reply_order(frame.limit(0)).count() == 0


def test_parts_of_messages_are_linked(spark):
    first = "alpha one two three\nbeta four five six\ngamma seven eight nine. Delta ten eleven twelve"
    asked = [
        "> alpha one two three\n> beta four five six\nlines", "> seven eight\npart", "> four five six gamma\n> seven eight\nwrapped",
        "> Delta ten eleven twelve\nsentence", "> nothing of this was ever said\nunknown",
    ]
    rows = [(1, 0, "a", first), (1, 1, "b", "beta is nice"), *[(1, i + 2, "a", t) for i, t in enumerate(asked)]]
    got = quotations.reply_order(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    assert rows_of(got.where("turn > 1"), "turn", "reply_to", "linked") == [
        (2, 0, True), (3, 0, True), (4, 0, True), (5, 0, True), (6, 5, False),
    ]


def test_messages_follow_what_they_answer(spark):
    texts = ["zero root", "one here", "two here", "> zero root\nthree", "four", "> one here\nfive", "> zero root\nsix"]
    rows = [(c, i, "a", t) for c, ts in ((1, texts), (2, ["x", "y", "z"])) for i, t in enumerate(ts)]
    got = quotations.reply_order(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    order = {(r["conv_id"], r["turn"]): r["reply_place"] for r in got.collect()}
    assert sorted(range(7), key=lambda i: order[1, i]) == [0, 1, 2, 5, 3, 4, 6] and sorted(order[1, i] for i in range(7)) == [*range(7)]
    assert [order[2, i] for i in range(3)] == [0, 1, 2]


# --- pages
PAGE = (
    "<!DOCTYPE html><html><head><title>t</title><style>p{}</style></head><body><nav><ul><li><a href=x>menu</a></ul></nav>"
    "<div class='ad'>buy</div><article><h1>Head&amp;line</h1><p><b>One\n two<br><p>three &lt;4&#x21; <script>var t='</p>';</script>end"
    "<aside>side</aside><div class='comments'>reader</div><form>f</form></article><footer>&copy; foot</footer>"
)


def test_main_text():
    assert style_tree.main_text(PAGE) == "Head&line\nOne two\nthree <4!\nend" or style_tree.main_text(PAGE) == "Head&line\nOne two\nthree <4! end"
    assert style_tree.main_text(None) == style_tree.main_text("") == style_tree.main_text("<p></p>") == ""
    assert style_tree.main_text("<article><p>cut at &am") == "cut at &am"
    assert style_tree.main_text("<article><p>cut in a tag <b class=") == "cut in a tag"


def test_the_tree_decides_inside_articles_too(spark):
    page = "<body><div class='x{}'>menu</div><article><h1>T{}</h1><p>text {}</p><p class='legal'>All rights reserved</p></article></body>"
    rows = [(i, "http://a.x/", page.format(i, i, i)) for i in range(6)]
    copies = [(100 + i, "http://b.x/", page.format(i, 1, 1)) for i in range(9)]  # one article below nine menus
    lines = [(200 + i, "http://c.x/", "<article>" + "<p>same</p>" * 9 + "</article>") for i in range(5)]
    frame = spark.createDataFrame(rows + copies + lines, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in style_tree.extract(frame).collect()}
    assert [got[i] for i in range(6)] == [f"T{i}\ntext {i}" for i in range(6)]
    assert {got[100 + i] for i in range(9)} == {"T1\ntext 1\nAll rights reserved"}
    assert {got[200 + i] for i in range(5)} == {"\n".join(["same"] * 9)}


def test_branches_that_every_page_shows_are_noise(spark):
    def page(i):
        return f"<body><div><p>Welcome to our site</p></div><section><p>Story {i} of {i * 7}</p><p>More {i}</p></section>"

    rows = [(i, f"http://h.example/{i}", page(i)) for i in range(8)]
    rows += [(20, "http://alone.example/", page(20)), (21, None, None), (22, "http://h.example/a", PAGE), (22, "http://h.example/a", PAGE)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit(1))
    got = {r["page_id"]: r["text"] for r in style_tree.extract(frame).collect()}
    assert [got[i] for i in range(8)] == [f"Story {i} of {i * 7}\nMore {i}" for i in range(8)]
    assert got[20].startswith("Welcome") and got[21] == "" and got[22] == style_tree.main_text(PAGE)
    assert style_tree.extract(frame.limit(0)).count() == 0


# --- fingerprints
def test_peeling_recovers_the_difference():
    rng = np.random.default_rng(3)
    pool = np.unique(rng.integers(0, 2**63, 3000, dtype=np.uint64))
    for n, m in ((0, 0), (5, 3), (700, 2), (900, 1200)):
        a, b = pool[: 900 + n], np.concatenate([pool[:900], pool[2000 - 1 : 2000 - 1 + m]]) if m < 1000 else pool[1500:]
        mine, other = invertible_sketch.difference(invertible_sketch.Digests(a), invertible_sketch.Digests(b))
        assert set(mine) == set(a) - set(b) and set(other) == set(b) - set(a)
    table = invertible_sketch.Table(invertible_sketch.Digests(pool[:9]), 16)
    again = invertible_sketch.Table.of_raw(table.raw())
    assert set(again.peel()[0]) == set(pool[:9])


def test_fingerprints_as_brute_force(spark):
    rng = random.Random(8)
    texts = [" ".join("w%d" % rng.randrange(90) for _ in range(rng.choice([3, 30, 300]))) for _ in range(60)]
    rows = [(1000 - i, t) for i, t in enumerate([*texts, None, "", "x", texts[3], texts[3]])] + [(None, "null id")]
    got = invertible_sketch.fingerprints(spark.createDataFrame(rows, DOC).repartition(4))
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    expected = [
        (d, *invertible_sketch.compared(invertible_sketch._Version(t), invertible_sketch._Version(order[(i + 1) % len(order)][1])))
        for i, (d, t) in enumerate(order)
    ]
    shown = [tuple(v.hex() if isinstance(v, bytes) else v for v in r) for r in expected]
    assert rows_of(got) == sorted(shown, key=repr)
    by_id = {r[0]: r for r in expected}
    assert by_id[1000 - 63][3] == by_id[1000 - 64][3]
    assert invertible_sketch.fingerprints(spark.createDataFrame([(1, "only")], DOC)).first()["near_next"] == 1.0
    assert invertible_sketch.fingerprints(spark.createDataFrame([], DOC)).count() == 0


# --- tokens
public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")
SAMPLES = [
    "", "a", "It's they're don't 'stop I'll'll !!'re", "x<|endoftext|>y !!<|endoftext|> <|endofte",
    "日本語テキスト漢字 русский ТЕКСТ Σίσυφος ΟΔΟΣ İstanbul é é ﬁ", "a\xa0b c\x1cd\x85e 12345 ½ ² ٣",
]


def test_every_prefix_counts_as_the_library_counts_it():
    counter = prefix_tokens.PrefixCounter(PATH)
    rng = random.Random(9)
    alphabet = "abcdehilnorst   '.!?ABTHE123éñßØ<|>\n\t"
    texts = SAMPLES + ["".join(rng.choice(alphabet) for _ in range(50)) for _ in range(30)]
    for text in texts:
        expected = [len(counter.library.encode(text[: i + 1], add_special_tokens=False)) for i in range(len(text))]
        assert counter.prefixes(text).tolist() == expected, text


def test_questions_answered_from_prefixes(spark):
    rows = [(i, t) for i, t in enumerate([*SAMPLES, None, "one two three four " * 50])]
    frame = prefix_tokens.prefix_tokens(spark.createDataFrame(rows, DOC).withColumn("n_tokens", F.lit("x")), PATH)
    counter = prefix_tokens.PrefixCounter(PATH)
    count = lambda t: len(counter.library.encode(t or "", add_special_tokens=False))
    got = frame.select(
        "doc_id", "n_bytes", prefix_tokens.n_tokens("prefix_tokens").alias("n"),
        prefix_tokens.tokens_of_first("prefix_tokens", 9).alias("nine"), prefix_tokens.longest_prefix("prefix_tokens", 7).alias("seven"),
    )
    for r in got.collect():
        text = rows[r["doc_id"]][1] or ""
        longest = max(i for i in range(len(text) + 1) if count(text[:i]) <= 7)
        assert tuple(r)[1:] == (len(text.encode()), count(text), count(text[:9]), longest)


def test_a_letter_costs_few_lookups():
    class Counted(dict):
        asked = 0

        def __contains__(self, token):
            Counted.asked += 1
            return super().__contains__(token)

    counter = prefix_tokens.PrefixCounter(PATH)
    counter.vocabulary = Counted(counter.vocabulary)
    word = "qzxvkjwqxzvjkqwzxjvkqzwxjkvqzxwjvkqx"
    assert counter.in_word(word) == [len(counter.library.encode(word[:n], add_special_tokens=False)) for n in range(1, len(word) + 1)]
    assert Counted.asked < 8 * len(word)


def test_tables_that_are_too_small_are_not_peeled(monkeypatch):
    peeled, peel = [], invertible_sketch.Table.peel
    monkeypatch.setattr(invertible_sketch.Table, "peel", lambda table: peeled.append(table.cells) or peel(table))
    random_digests = np.random.default_rng(3).integers(1, 2**63, 400).astype(np.uint64)
    one, two = (invertible_sketch.Digests(np.unique(d)) for d in (random_digests[:200], random_digests[200:]))
    mine, other = invertible_sketch.difference(one, two)
    assert sorted(mine) == sorted(one.digests) and sorted(other) == sorted(two.digests)
    assert peeled == [1024]
