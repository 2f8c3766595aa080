"""Inputs made to break hashes, to take quadratic time or to exceed limits of numbers."""

import time

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from skein.llm import covering_dedup, html_text, substring_dedup, surrogates, token_records, weighted_fingerprints, words

BPE = public_tokenizers.path("byte_bpe_50k.json")


def thue_morse(n, letters="ab"):
    """A word and its complement: their polynomial hashes modulo a power of two are equal, whatever the base."""
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return [letters[b] for b in bits], [letters[1 - b] for b in bits]


@pytest.mark.parametrize("n", [1024, 2048, 4096])
def test_hashes_tell_such_words_apart(n):
    a, b = thue_morse(n)
    block = next(words.blocks(pa.array(["".join(a) + " " + "".join(b)]), words.SPACED))
    assert len(set(block.hashes().tolist())) == 2
    values = np.array([ord(c) for c in a + b], np.uint64)
    assert len(set(words.span_hashes(values, np.array([0, n]), np.array([n, 2 * n])).tolist())) == 2
    assert len(set(words.window_hashes(values, n)[[0, n]].tolist())) == 2


def test_hashes_depend_on_content_alone():
    draw = np.random.default_rng(2)
    values = draw.integers(0, 1 << 64, 5000, dtype=np.uint64)
    values[3000:3100] = values[17:117]
    for k in (1, 2, 3, 5, 7, 10, 13, 20, 64):
        got = words.window_hashes(values, k)
        assert len(got) == 5001 - k and (got[3000 : 3101 - k] == got[17 : 118 - k]).all() and len(set(got.tolist())) == 5001 - k - (101 - k)
    assert len(words.window_hashes(values[:4], 5)) == 0
    prime = (1 << 61) - 1
    x, y = values[:100] % np.uint64(prime), values[100:200] % np.uint64(prime)
    assert words._times(x, y).tolist() == [int(p) * int(q) % prime for p, q in zip(x, y, strict=True)]
    texts = ["a", "ab", "abcdefgh", "abcdefghi", "abcdefgh\0", "", "é" * 9, "x" * 1000]
    data = "".join(texts).encode()
    ends = np.cumsum([len(t.encode()) for t in texts])
    hashes = words.byte_hashes(np.frombuffer(data, np.uint8), ends - [len(t.encode()) for t in texts], ends)
    again = [words.byte_hashes(np.frombuffer(t.encode(), np.uint8), np.array([0]), np.array([len(t.encode())]))[0] for t in texts]
    assert hashes.tolist() == again and len(set(again)) == len(texts)


def test_token_ids_of_such_words():
    a, b = thue_morse(1024)
    texts = ["!" + "".join(a), "!" + "".join(b), "".join(a) + " " + "".join(b)]
    plain = Tokenizer.from_file(BPE)
    assert [x.tolist() for x in token_records.PieceEncoder(BPE).encode(texts)] == [plain.encode(t, add_special_tokens=False).ids for t in texts]


def test_such_words_are_no_copies(spark):
    """Passages, near-duplicates and fingerprints take words, and rows of two words, that are alike in this way for what they are."""
    a, b = ("".join(x) for x in thue_morse(2048))
    filler = [f"w{i}" for i in range(30)]
    rows = [(1, " ".join([a, *filler[:15]])), (2, " ".join([b, *filler[15:]])), (3, " ".join(thue_morse(1024, ["x", "y"])[0])), (4, " ".join(thue_morse(1024, ["x", "y"])[1]))]
    docs = spark.createDataFrame(rows[:2], "doc_id long, text string")
    assert [r.n_removed for r in substring_dedup.remove_earlier_passages(docs, window=1).collect()] == [0, 0]
    assert covering_dedup.drop_near_duplicates(spark.createDataFrame([(1, a), (2, b)], "doc_id long, text string"), words=5, similarity=0.8).count() == 2
    assert {h.tolist()[0] != h.tolist()[1] for block in words.blocks(pa.array([rows[2][1], rows[3][1]]), words.SPACED) for h in covering_dedup._shingles(block, 5)[2]} == {True}
    found = weighted_fingerprints.compare_with_next(docs, part=3).collect()
    assert len({r.fingerprint for r in found}) == 2


def forest(sets, similarity):
    """Roots of the links that _set_forest gives, and how many there are."""
    values = np.array([v for s in sets for v in sorted(s)], np.int64)
    first = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    links = list(covering_dedup._set_forest(np.arange(len(sets)), values, first, similarity))
    return rooted(len(sets), links), len(links)


def rooted(n, links):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


@pytest.mark.parametrize("similarity", [0.5, 0.8, 0.9, 1.0])
def test_set_forest_equals_all_pairs(similarity):
    draw = np.random.default_rng(int(10 * similarity))
    for _ in range(10):
        sets = []
        for _ in range(90):
            s = set(sets[draw.integers(len(sets))]) if sets and draw.random() < 0.7 else set(draw.integers(-50, 50, draw.integers(0, 30)).tolist())
            for _ in range(draw.integers(0, 6)):
                s ^= {int(draw.integers(-50, 50))}
            sets.append(s)
        want = rooted(90, [(i, j) for i in range(90) for j in range(i) if len(sets[i] & sets[j]) >= similarity * len(sets[i] | sets[j]) - 1e-9])
        assert forest(sets, similarity) == (want, 90 - len(set(want)))


def test_filled_in_templates_take_linear_time():
    """20,000 sets that share 17 of 20 values, at a similarity of 0.74, and as many that are all near copies."""
    began = time.process_time()
    assert forest([{*range(17), *(100 + 3 * i + k for k in range(3))} for i in range(20_000)], 0.8)[1] == 0
    assert forest([{*range(40), 100 + 2 * i, 101 + 2 * i} for i in range(20_000)], 0.8)[1] == 19_999
    assert time.process_time() - began < 30


@pytest.mark.parametrize("size", [10_000, 100_000])
def test_long_values_get_surrogates(spark, size):
    text = {"secret": "token=" + "ab3X" * (size // 4), "email": "é" * size + "@mail.com", "domain": "john@" + "d" * size + ".com", "name": "Mr Q" + "w" * size, "greek": "Κύριος Π" + "α" * size, "key": "sk-" + "a1" * (size // 2), "iban": "GB29 NWBK 6016 1331 9268 19"}
    docs = spark.createDataFrame([(k, v) for k, v in text.items()], "doc_id string, text string")
    done = surrogates.replace_entities(docs, key=b"k")
    got = {r.doc_id: r for r in done.collect()}
    assert all(len(r.entities) == 1 and r.text != text[k] and r.entities[0].surrogate != r.entities[0].entity for k, r in got.items())
    assert surrogates.collisions(done).count() == 0


def test_blocks_of_long_values_stay_distinct():
    make = surrogates.Surrogates(b"k")
    base = "x7" * 200
    values = {base[:i] + c + base[i + 1 :] for i in (0, 63, 64, 65, 127, 128, 200, 399) for c in "y5"} | {base, base[:-1], base[:64], base[:65]}
    values = {v for v in values if len(v) > 60}
    made = [make._spell("secret", v, make.shape(v)) for v in values]
    assert len(set(made)) == len(values) and not set(made) & values and all(make.shape(v) in {make.shape(w) for w in values} for v in made)


@pytest.mark.parametrize("local", ["Ιωάννης.Παπαδόπουλος", "张伟", "josé.núñez", "Ülkü", "محمد", "иван.петров", "さくら", "김민수", "٣٤٥"])
def test_no_letter_of_an_address_stays(local):
    make = surrogates.Surrogates(b"k")
    new = make.email(f"{local}@example.org").partition("@")[0]
    low = local.lower()
    assert len(new) == len(low) and all(a == b for a, b in zip(low, new, strict=True) if a == ".") and new != low
    assert sum(a == b for a, b in zip(low, new, strict=True) if a != ".") <= len(low) // 3
    assert make.email(f"{local}@example.org") == make.email(f"{local.upper()}@example.org") or local.upper().lower() != low


def test_a_number_to_call_is_one_however_written():
    make = surrogates.Surrogates(b"k")
    found = make.rewrite("+49 30 1234567, +49301234567 and 0049 30 1234567")[1]
    assert len({"".join(c for c in s if c.isdigit()).removeprefix("00") for _, _, s in found}) == 1 and len(found) == 3 and all(s.lstrip("+0").startswith("49") for _, _, s in found)


@pytest.mark.parametrize("page", ["<a " * 1_000_000, "<b>" * 200_000 + "</i>" * 200_000, '<a "x>" ' * 300_000 + "'", '<a "' * 600_000, "<!" * 1_000_000, "<!-- " * 400_000, "<b>" * 100_000 + "<div></div>" * 100_000, "<textarea>" * 100_000, "<b><td>" + "<i>" * 100_000 + "</b>" * 100_000, "<ul>" + "<li><b>" * 60_000, "<a '>" * 300_000 + '"'])
def test_broken_pages_take_linear_time(page):
    began = time.process_time()
    html_text.main_text(page)
    assert time.process_time() - began < 20


def test_inline_parts_of_a_paragraph_stay():
    page = "<main><article><h1>On sums</h1><p>We have <math><mi>a</mi><mo>+</mo><mi>b</mi></math> here, as is well known, and more of it.</p><p>Use <label>this</label> at <meter>6</meter> of ten.</p></article></main>"
    assert html_text.main_text(page) == "On sums\n\nWe have a+b here, as is well known, and more of it.\n\nUse this at 6 of ten."


def test_null_ids_of_templates(spark):
    """Templates through the whole stage: candidates of similarity 0.74 all stay."""
    shared = " ".join(f"shared{i}" for i in range(21))
    rows = [(i, f"{shared} own{i}x own{i}y own{i}z") for i in range(300)]
    assert covering_dedup.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words=5, similarity=0.8).filter(F.col("doc_id") >= 0).count() == 300
