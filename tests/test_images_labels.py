"""Image rules, near-duplicates, label normalization and annotation runs."""

import json
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from skein.operators import images, labels, near_duplicates
from skein.plans import image_gate

METRIC_TYPES = "nature double, green double, blue double, foreground double, person_count int, total_person double, max_person double"
RULES = [
    ((0.445, 0.338, 0.107, 0.061, 0, 0.0, 0.0), "landscape_no_person_nature_dominant"), ((0.914, 0.5, 0.4, 0.002, 1, 0.007, 0.007), "landscape_person_too_small_nature_dominant"), ((0.35, 0.2, 0.15, 0.0, 0, 0.0, 0.0), "landscape_no_person_nature_dominant"),
    ((0.9, 0.7, 0.2, 0.0, 1, 0.13, 0.13), "not_landscape_person_subject_large_enough"), ((0.9, 0.7, 0.2, 0.0, 3, 0.01, 0.01), "not_landscape_people_present_as_scene_subject"), ((0.9, 0.7, 0.2, 0.08, 0, 0.0, 0.0), "not_landscape_has_large_foreground_subject"),
    ((0.9, 0.7, 0.2, 0.0, -1, -1.0, -1.0), "high_confidence_landscape_by_nature_color"), ((0.5, 0.4, 0.1, 0.0, -1, -1.0, -1.0), "not_landscape_by_color_and_subject"), ((0.85, 0.45, 0.4, 0.0, -1, -1.0, -1.0), "not_landscape_by_color_mix"),
]


def test_landscape_rules(spark):
    df = spark.createDataFrame([m for m, _ in RULES], METRIC_TYPES)
    got = df.select(images.landscape(*[F.col(c) for c in images.METRICS[:-1]]).alias("v")).select("v.*").collect()
    assert [r.rule for r in got] == [rule for _, rule in RULES] and [r.is_landscape for r in got] == [not rule.startswith("not_") for _, rule in RULES]


def test_average_hash_and_distance(spark):
    pixels = [float(x) for x in range(64)]
    h = spark.createDataFrame([(pixels,)], "p array<double>").select(images.average_hash(F.col("p")).alias("h")).first().h
    assert h & (1 << 64) - 1 == (1 << 32) - 1
    d = spark.createDataFrame([(h, -1)], "a long, b long").select(images.hamming(F.col("a"), F.col("b")).alias("d")).first().d
    assert d == 32


def test_color_ratios():
    import colorsys

    rng = np.random.default_rng(0)
    x = rng.integers(0, 256, (12, 12, 3))
    green = blue = 0
    mask = np.zeros((12, 12), bool)
    for i in range(12):
        for j in range(12):
            h, s, v = colorsys.rgb_to_hsv(*(x[i, j] / 255))
            h, s, v = h * 179, s * 255, v * 255
            g, b = 35 <= h <= 85 and s >= 40 and v >= 40, 90 <= h <= 130 and s >= 40 and v >= 40
            green, blue = green + g, blue + (b and not g)
            mask[i, j] = s >= 50 and v >= 35 and not g and not b
    seen, best = set(), 0
    for start in zip(*np.nonzero(mask), strict=True):
        stack, n = [tuple(map(int, start))], 0
        while stack:
            p = stack.pop()
            if p in seen or not (0 <= p[0] < 12 and 0 <= p[1] < 12) or not mask[p]:
                continue
            seen.add(p)
            n += 1
            stack += [(p[0] + 1, p[1]), (p[0] - 1, p[1]), (p[0], p[1] + 1), (p[0], p[1] - 1)]
        best = max(best, n)
    assert images.color_ratios(x) == pytest.approx(((green + blue) / 144, green / 144, blue / 144, best / 144))
    assert images.largest_component(np.zeros((4, 4), bool)) == 0


@pytest.mark.parametrize("distance", [0, 4, 9, 16])
def test_gate_equals_the_scan_in_order(spark, distance):
    rng = random.Random(distance)
    centers = [rng.getrandbits(64) for _ in range(10)]
    hashes = [rng.choice(centers) ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(0, distance + 3))) for _ in range(120)]
    signed = [h - (1 << 64) if h >> 63 else h for h in hashes]
    accepted, want = [], []
    for i, h in enumerate(hashes):
        first = next((j for j in accepted if (hashes[j] ^ h).bit_count() <= distance), None)
        accepted += [i] if first is None else []
        want.append((i, first is None, first))
    items = spark.createDataFrame(list(enumerate(signed)), "pos long, hash long")
    got = near_duplicates.gate(items, distance).orderBy("pos").select("pos", "accepted", "duplicate_of").collect()
    assert [tuple(r) for r in got] == want


def test_quality_and_gate(spark):
    gray = [float(i) for i in range(64)]
    base = {"nature": 0.1, "green": 0.05, "blue": 0.05, "foreground": 0.2, "person_count": -1, "total_person": -1.0, "max_person": -1.0, "max_conf": -1.0}
    cases = [(True, True, 400, 400, {}), (False, False, None, None, {}), (True, False, None, None, {}), (True, True, 299, 400, {}), (True, True, 2000, 400, {}), (True, True, 400, 400, {"nature": 0.5, "foreground": 0.0, "person_count": 0}), (True, True, 500, 400, {})]
    rows = [(i, f"i{i}", "n", f"/p{i}", e, d, w, h, *(base | m).values(), gray) for i, (e, d, w, h, m) in enumerate(cases)]
    df = spark.createDataFrame(rows, f"pos long, Image_ID string, note_id string, image_path string, file_exists boolean, decodable boolean, width int, height int, {METRIC_TYPES}, max_conf double, gray8 array<double>")
    out = {r.pos: r for r in image_gate.gate_images(df).collect()}
    assert [out[i].image_type for i in range(7)] == ["candidate_outfit", "missing_file", "corrupted_image", "too_small", "bad_aspect_ratio", "landscape", "duplicate"]
    assert out[6].duplicate_of == "i0" and not out[6].passed and out[6].confidence == 0 and out[0].confidence == 1 and out[4].aspect_ratio == 5.0
    assert out[5].reject_reason == "landscape_no_person_nature_dominant: nature=0.500, green=0.050, blue=0.050, foreground=0.000, persons=0, total_person=-1.000, max_person=-1.000, max_conf=-1.000"
    log = images.gate_log(image_gate.gate_images(df)).first()
    assert (log.total_images, log.passed, log.rejected) == (7, 1, 6) and log.image_type_breakdown["duplicate"] == 1 and log.rejection_kinds["landscape_no_person_nature_dominant"] == 1


def test_measure(spark, tmp_path):
    def decode(raw):
        if raw[:1] != b"P":
            raise ValueError("no picture")
        return np.full((320, 400, 3), (0, 200, 0))

    records = spark.createDataFrame([(0, "a", "n", "/a"), (1, "b", "n", "/b"), (2, "c", "n", "/c")], "pos long, Image_ID string, note_id string, image_path string")
    files = spark.createDataFrame([("/a", b"P"), ("/b", b"x"), ("/other", b"P")], "image_path string, content binary")
    boxes = spark.createDataFrame([("/a", [(0.0, 0.0, 100.0, 320.0, 0.9), (0.0, 0.0, 9.0, 9.0, 0.1)])], "image_path string, boxes array<struct<x1:double,y1:double,x2:double,y2:double,confidence:double>>")
    got = {r.Image_ID: r for r in image_gate.measure(records, files, decode, boxes).collect()}
    assert got["a"].green == 1.0 and got["a"].person_count == 1 and got["a"].total_person == 0.25 and got["a"].width == 400
    assert not got["b"].decodable and got["b"].file_exists and not got["c"].file_exists
    assert image_gate.measure(records, files, decode).filter("person_count = -1").count() == 3


LABELS = [
    ({}, {"Curation_Status": "review", "Reject_Reason": "too_unclear", "Zipper_Type": "None", "Pockets": 0, "Reflective": False, "Primary_Color": "unclear", "Secondary_Color": "none", "Material_Clue": ["unclear"], "Confidence": 0.0, "Fit": "Unclear"}),
    ({"Curation_Status": " reject ", "Reject_Reason": "none", "Material_Clue": [], "Pockets": "4", "Confidence": "1.7", "Reflective": "Yes"}, {"Curation_Status": "reject", "Reject_Reason": "too_unclear", "Material_Clue": ["unclear"], "Pockets": 4, "Confidence": 1.0, "Reflective": True}),
    ({"Curation_Status": "use", "Material_Clue": [" a", "", "b", "c", "d", "e"], "Pockets": -2, "Outfit_Count": 2.9, "Confidence": -1, "Reflective": True, "Zipper_Type": "sealed"}, {"Reject_Reason": "none", "Material_Clue": ["a", "b", "c", "d"], "Pockets": 0, "Outfit_Count": 2, "Confidence": 0.0, "Reflective": True, "Zipper_Type": "Unclear"}),
    ({"Material_Clue": "nylon ", "Primary_Color": None, "Secondary_Color": " red ", "Fit": "Loose", "Gorpcore_Relevance": 0.25}, {"Material_Clue": ["nylon"], "Primary_Color": "unclear", "Secondary_Color": "red", "Fit": "Loose", "Gorpcore_Relevance": 0.25}),
]


@pytest.mark.parametrize("raw,want", LABELS)
def test_labels(spark, raw, want):
    df = spark.createDataFrame([("i", "n", "p", json.dumps(raw))], "Image_ID string, note_id string, image_path string, raw_model_output string")
    got = labels.normalize_labels(df).first().asDict()
    assert {k: got[k] for k in want} == want and len(got) == 22


def test_labels_that_are_no_objects(spark):
    df = spark.createDataFrame([("i", "n", "p", x) for x in (None, "", "no json", "[1]")], "Image_ID string, note_id string, image_path string, raw_model_output string")
    assert {r.Curation_Status for r in labels.normalize_labels(df).collect()} == {"review"}


def test_annotation_run(spark):
    def client():
        def ask(path):
            if path == "/bad":
                raise RuntimeError("down")
            return "[]" if path == "/list" else '{"Curation_Status": "use", "Image_Category": "landscape"}'

        return ask

    rows = spark.createDataFrame([("1", "n", "/a"), ("2", "n", "/bad"), ("3", "n", "/gone"), ("4", "n", "/list"), ("5", "n", "/known"), ("6", "n", "/beyond")], "Image_ID string, note_id string, image_path string")
    files = spark.createDataFrame([(p,) for p in ("/a", "/bad", "/list", "/known", "/beyond")], "image_path string")
    known = spark.createDataFrame([("5",)], "Image_ID string")
    run = labels.run_annotator(rows, known, files, client, limit=5)
    assert {r.Image_ID: r.run_status for r in run["runs"].collect()} == {"1": "annotated", "2": "error", "3": "missing_file", "4": "error", "5": "skipped_existing"}
    assert {r.Image_ID: r.error_type for r in run["errors"].collect()} == {"2": "RuntimeError", "3": "missing_file", "4": "ValueError"}
    log = labels.curation_log(run["runs"], run["labels"])
    assert {r.Image_ID: r.Image_Category for r in log.collect()} == {"1": "landscape", "2": "", "3": "", "4": "", "5": ""}
    summary = labels.annotation_log(log).first()
    assert (summary.total_candidates, summary.annotated_count, summary.skipped_existing, summary.error_count) == (5, 1, 1, 3) and summary.curation_status_breakdown == {"use": 1, "unknown": 4}
    assert labels.pending(rows, known, limit=5).count() == 4


def test_every_image_is_asked_once(spark, tmp_path):
    """All frames of a run are consumed, a run ends half-way, and the next goes on: each image is asked for once, failed ones once a run."""
    calls, log = tmp_path / "calls", f"file://{tmp_path}/answers"

    def client():
        def ask(path):
            with calls.open("a") as f:
                f.write(f"{path}\n")
            if path == "/7" and not (tmp_path / "healed").exists():
                raise RuntimeError("down")
            return json.dumps({"Curation_Status": "use", "Confidence": len(calls.read_text()) / 1e9})  # another answer each time

        return ask

    rows = spark.createDataFrame([(str(i), "n", f"/{i}") for i in range(40, 0, -1)], "Image_ID string, note_id string, image_path string").coalesce(1)
    files = rows.select("image_path")
    known = spark.createDataFrame([("39",)], "Image_ID string")
    asked = lambda: Counter(calls.read_text().split())

    with pytest.MonkeyPatch.context() as patch:  # the first run ends after two of its waves
        plain, waves = labels.annotate, []

        def killed(*args):
            waves.append(1)
            if len(waves) > 2:
                raise KeyboardInterrupt
            return plain(*args)

        patch.setattr(labels, "annotate", killed)
        with pytest.raises(KeyboardInterrupt):
            labels.run_annotator(rows, known, files, client, log=log, wave_rows=10)
    begun = asked()
    assert 0 < len(begun) < 39 and set(begun.values()) == {1}
    run = labels.run_annotator(rows, known, files, client, log=log, wave_rows=10)
    for _ in range(2):
        got = {r.Image_ID: r.run_status for r in run["runs"].collect()}
        said = {r.Image_ID: r.Confidence for r in run["labels"].collect()}
        failed = [r.Image_ID for r in run["errors"].collect()]
    assert got == {str(i): "annotated" for i in range(1, 41)} | {"39": "skipped_existing", "7": "error"} and failed == ["7"] and len(said) == 38
    counts = asked()
    assert all(n == 1 for p, n in counts.items() if p != "/7") and len(counts) == 39 and counts["/7"] <= 2
    (tmp_path / "healed").touch()
    again = labels.run_annotator(rows, known, files, client, log=log)
    assert {r.Image_ID: r.Confidence for r in again["labels"].collect() if r.Image_ID != "7"} == said
    assert sum(asked().values()) == sum(counts.values()) + 1 and again["errors"].count() == 0
    assert {r.Image_ID for r in labels.run_annotator(rows, known, files, client, limit=3, log=log)["runs"].collect()} == {"40", "39", "38"}  # in input order


def test_base64_has_no_breaks(spark):
    got = spark.createDataFrame([(b"x" * 300,)], "c binary").select(images.base64_text(F.col("c")).alias("b")).first().b
    assert len(got) == 400 and "\n" not in got


def test_far_pairs_beyond_one_block(spark, monkeypatch):
    rng = random.Random(6)
    base = [rng.getrandbits(63) for _ in range(60)]
    values = sorted({b ^ sum(1 << i for i in rng.sample(range(63), rng.randrange(12))) for b in base for _ in range(3)})
    monkeypatch.setattr(near_duplicates, "BLOCK_ROWS", 50)
    items = spark.createDataFrame(list(enumerate(values)), "pos long, hash long")
    got = sorted(tuple(r) for r in near_duplicates.near_pairs(items, 16).collect())
    want = [(i, j, (values[i] ^ values[j]).bit_count()) for i in range(len(values)) for j in range(i + 1, len(values)) if (values[i] ^ values[j]).bit_count() <= 16]
    assert len(values) > 50 and got == want
    assert near_duplicates.near_pairs(items, 16).count() == len(want) == near_duplicates.near_pairs(items, 16).select("a").distinct().join(items, F.col("a") == F.col("pos")).count() + len(want) - len({a for a, _, _ in want})


@pytest.mark.parametrize("distance", [0, 1, 3, 4, 5, 7, 9, 14, 15])
def test_near_pairs_of_every_plan(spark, distance):
    rng = random.Random(distance)
    base = [rng.getrandbits(64) for _ in range(15)]
    values = sorted({b ^ sum(1 << i for i in rng.sample(range(64), rng.randrange(distance + 2))) for b in base for _ in range(8)})
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    got = sorted(tuple(r) for r in near_duplicates.near_pairs(spark.createDataFrame(list(enumerate(signed)), "pos long, hash long"), distance).collect())
    assert got == [(i, j, d) for i in range(len(values)) for j in range(i + 1, len(values)) if (d := (values[i] ^ values[j]).bit_count()) <= distance]
    assert near_duplicates.near_pairs(spark.createDataFrame([], "pos long, hash long"), distance).count() == 0
