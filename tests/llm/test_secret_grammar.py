"""The inferred grammars: structure and length are learned, and add spans on planted credentials."""

import collections
import itertools
import random
import string

import pytest
from pyspark.sql import functions as F

from martline.llm import queries, secret_scan
from martline.llm.secret_scan import Automaton

HEX = "0123456789abcdef"
ALNUM = string.ascii_letters + string.digits
WORDS = collections.Counter("the quick brown fox jumps over the lazy dog and runs 1 of 2 times " * 200)


def draw(rng, pattern):
    """``h``: hexadecimal, ``H``: the same in upper case, ``A``: any letter or digit, ``9``: digit; others as they are."""
    sets = {"h": HEX, "H": HEX.upper(), "A": ALNUM, "9": string.digits}
    return "".join(rng.choice(sets[c]) if c in sets else c for c in pattern)


FORMATS = {"hex40": "h" * 40, "token20": "A" * 20, "uuid": "-".join("h" * n for n in (8, 4, 4, 4, 12)), "prefixed": "x_pat_" + "A" * 16}


@pytest.mark.parametrize("name", sorted(FORMATS))
def test_structure_and_length_are_learned(name):
    rng = random.Random(1)
    a = Automaton([draw(rng, FORMATS[name]) for _ in range(300)])
    grammar = secret_scan.fit_grammar([("assign", draw(rng, FORMATS[name])) for _ in range(300)], WORDS)
    fresh = [draw(rng, FORMATS[name]) for _ in range(300)]
    assert len(a.states) > 1
    assert sum(map(grammar.is_credential, fresh)) > 285
    half, double = [s[:len(s) // 2] for s in fresh], [s + s for s in fresh]
    assert not any(map(grammar.is_credential, half)) and not any(map(grammar.is_credential, double))
    # a literal prefix is cheap per character, so structure is compared in bits
    structure = lambda found: sum(a.surprise(s)[0] for s in found) / len(found)
    assert structure(half) > structure(fresh) + 6
    assert not any(grammar.is_credential(draw(rng, "9" * 20)) for _ in range(300)) or name == "token20"
    assert grammar.least == len(FORMATS[name])


def test_loops_are_merged_and_structure_is_not():
    rng = random.Random(2)
    values = [".".join(draw(rng, "AAAA") for _ in range(rng.randrange(1, 12))) for _ in range(600)]
    prefixes = {tuple(x for x, _ in secret_scan.segments(v))[:n] for v in values for n in range(30)}
    dotted = Automaton(values)
    assert len(prefixes) > 1_000 and len(dotted.states) < 60
    uuid = Automaton([draw(rng, FORMATS["uuid"]) for _ in range(300)])
    assert uuid.structure_bits([("f", 8), ("-", 1), ("f", 4), ("-", 1), ("f", 4), ("-", 1), ("f", 4), ("-", 1), ("f", 12)]) < 1
    assert uuid.structure_bits([("f", 8), ("-", 1), ("f", 4), ("-", 1), ("f", 4), ("-", 1), ("f", 12)]) > 6


def test_few_values_teach_their_format_and_no_more():
    rng = random.Random(3)
    grammar = secret_scan.fit_grammar([("assign", draw(rng, "A" * 24)) for _ in range(3)], WORDS)
    assert set(grammar.automata) == {"assign"}
    assert sum(grammar.is_credential(draw(rng, "A" * 24)) for _ in range(100)) > 90
    assert not any(grammar.is_credential(draw(rng, "A" * n)) for n in (8, 12, 23, 25, 48) for _ in range(50))
    assert not any(map(grammar.is_credential, ["internationalisationandso", "thequickbrownfoxjumpsover"]))


def test_least_length_loses_nothing():
    rng = random.Random(4)
    values = [draw(rng, "A" * rng.randrange(8, 20)) for _ in range(200)] + [draw(rng, "99-AAAA") for _ in range(40)]
    a = Automaton(values)
    bound = a.structure + 2
    least = a.shortest(bound)
    shapes = [(s, n) for s in "0fgGFm" for n in range(1, 8)]
    for first in shapes:
        for rest in ([], [("-", 1)], *([("-", 1), x] for x in shapes)):
            shape = [first, *rest]
            if sum(n for _, n in shape) < least:
                assert a.structure_bits(shape) > bound


def plant(docs, rng, spark):
    """Documents with labelled values of three formats, and with bare ones; (documents, bare spans by id)."""
    formats = {"token20": "A" * 20, "upper40": "H" * 40, "prefixed": "x_pat_" + "A" * 16}
    rows, bare = [], {}
    for i, (pattern, k) in enumerate(itertools.product(formats.values(), range(60))):
        value = draw(rng, pattern)
        if k < 40:
            rows.append((10_000_000 + i, f"Über alles: token = \"{value}\" und so weiter"))
        else:
            text = rng.choice([f"Über {value} steht hier", f"key {value}\nend", f"see {value}"])
            rows.append((10_000_000 + i, text))
            bare[10_000_000 + i] = (text.index(value), text.index(value) + len(value))
    return docs.unionByName(spark.createDataFrame(rows, "doc_id bigint, text string")), bare


@pytest.mark.parametrize("folder", ["sf0.01", "sf0.1"])
def test_query_adds_planted_formats_and_little_else(spark, monkeypatch, folder):
    rng = random.Random(5)
    whole = spark.read.parquet(f"/root/testdata/{folder}/documents.parquet").select("doc_id", "text")
    docs, bare = plant(whole, rng, spark)
    monkeypatch.setattr(queries, "documents", lambda *a: docs)
    spans = {r.doc_id: [s.split(":") for s in r.spans.split(",") if s.startswith("format")] for r in queries.op5_secrets(spark, "").where(F.col("spans").contains("format")).collect()}
    found = {(d, int(a), int(b)) for d, found in spans.items() for _, a, b in found}
    wanted = {(d, *span) for d, span in bare.items()}
    recall = len(found & wanted) / len(wanted)
    precision = len(found & wanted) / len(found)
    print(folder, "precision", precision, "recall", recall, len(found))
    assert recall >= 0.95 and precision >= 0.95


def test_values_of_one_hash_part_and_many_tasks(spark):
    rng = random.Random(6)
    rows = [(i, f"password: {draw(rng, 'A' * 12)}") for i in range(3 * secret_scan.PER_KIND)]
    fits = [secret_scan.fit(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(n)) for n in (1, 7)]
    a, b = (g.automata["assign"] for g in fits)
    assert a.states[0].arrivals == b.states[0].arrivals == secret_scan.PER_KIND
    assert a.states[0].taken == b.states[0].taken and fits[0].least == fits[1].least == 12
