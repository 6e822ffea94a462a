"""The pipeline's stages, each on its own input, against brute force; and what the entry file does without them."""

import math
import shutil
import subprocess
import sys
from collections import Counter
from pathlib import Path

import pytest

import __spark_entry__ as contract
import corpus_pipeline as cp
from tests.llm.helpers import MESSY_SCHEMA, messy
from tests.llm.test_decontaminate import overlap
from tests.llm.test_host_quality import expected_kept
from tests.llm.test_mixing import filled
from tests.llm.test_near_dedup import expected_groups
from tests.llm.test_sharding import check_slots
from tests.llm.helpers import tokens, words

REPO = Path(__file__).resolve().parents[2]


FOLDER = "/root/testdata/sf0.001"


class Staged:
    """What a stage was given and what came out of it, written and reread."""

    def __init__(self, spark, place, name, given):
        place = str(place / name)
        dict(cp.STAGES)[name](spark, given, FOLDER).write.parquet(place)
        self.out = spark.read.parquet(place)
        self.before, self.after = given.columns, self.out.columns
        self.rows = tuple([r.asDict() for r in df.collect()] for df in (given, self.out))


@pytest.fixture(scope="module")
def place(tmp_path_factory):
    return tmp_path_factory.mktemp("stages")


@pytest.fixture(scope="module")
def quality(spark, place):
    return Staged(spark, place, "quality", spark.read.parquet(f"{FOLDER}/documents.parquet"))


@pytest.fixture(scope="module")
def near_duplicates(spark, place, quality):
    return Staged(spark, place, "near_duplicates", quality.out)


@pytest.fixture(scope="module")
def decontamination(spark, place, near_duplicates):
    return Staged(spark, place, "decontamination", near_duplicates.out)


@pytest.fixture(scope="module")
def mixture(spark, place, decontamination):
    return Staged(spark, place, "mixture", decontamination.out)


@pytest.fixture(scope="module")
def shards(spark, place, mixture):
    return Staged(spark, place, "shards", mixture.out)


NAMES = ["quality", "near_duplicates", "decontamination", "mixture", "shards"]


@pytest.mark.parametrize("name", NAMES)
def test_names_and_columns(name, request):
    assert [n for n, _ in cp.STAGES] == NAMES
    stage = request.getfixturevalue(name)
    assert stage.after == (stage.before if name != "shards" else [*stage.before, "shard", "slot"])


def ids(rows):
    return Counter(r["doc_id"] for r in rows)


def test_quality(quality):
    docs, kept = quality.rows
    expected = expected_kept([(r["doc_id"], r["text"], r["source"]) for r in docs])
    assert ids(kept) == Counter(expected) and 0 < len(kept) < len(docs)


def test_near_duplicates(near_duplicates):
    docs, kept = near_duplicates.rows
    groups = expected_groups({r["doc_id"]: r["text"] for r in docs}, 5)
    assert ids(kept) == Counter(c for _, c in set(groups.values())) or ids(kept) == Counter(set(c for _, c in groups.values()))


def test_decontamination(spark, decontamination):
    docs, kept = decontamination.rows
    items = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()]
    known = [set(tokens(t)) for t in items]
    leaked = {
        r["doc_id"]
        for r in docs
        for t, k in zip(items, known, strict=True)
        if len(k & set(tokens(r["text"]))) > 7 and overlap(r["text"], t)
    }
    assert ids(kept) == Counter(r["doc_id"] for r in docs if r["doc_id"] not in leaked)


def test_mixture(mixture):
    docs, mix = mixture.rows
    sizes, taken = {}, {}
    for rows, sums in ((docs, sizes), (mix, taken)):
        for r in rows:
            sums[r["source"]] = sums.get(r["source"], 0) + len(words(r["text"]))
    target, longest = filled(sizes), max(len(words(r["text"])) for r in docs)
    assert all(abs(taken.get(s, 0) - target[s]) <= longest / 2 + 1 for s in sizes)
    assert max(ids(mix).values()) <= 2 and ids(mix).keys() <= ids(docs).keys()


def test_shards(shards):
    docs, dealt = shards.rows
    assert ids(dealt) == ids(docs)
    check_slots(dealt, 16, len(docs))


def test_run_is_the_stages_in_order(spark, folder, shards):
    out = contract.queries()["pipeline"](spark, folder)
    dealt = shards.rows[1]
    assert ids([r.asDict() for r in out.select("doc_id").collect()]) == ids(dealt)
    assert out.columns == [*cp.COLUMNS, "shard", "slot"]


def test_messy_rows_pass_every_stage(spark, folder):
    rows = messy(spark)
    for _, stage in cp.STAGES[:-1]:
        assert stage(spark, rows, folder).dtypes == rows.dtypes
        assert stage(spark, spark.createDataFrame([], MESSY_SCHEMA), folder).count() == 0


def test_all_operators_are_registered():
    names = contract.queries()
    assert all(sum(n.startswith(f"op{i}_") for n in names) == 1 for i in range(1, 14)) and "pipeline" in names
    assert set(contract.oracle_sql()) <= set(names)


def test_the_rest_stands_without_these_folders(tmp_path):
    ignored = shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__", "spark-warehouse")
    shutil.copytree(REPO, tmp_path / "rest", ignore=ignored)
    (tmp_path / "rest/freightlane/llm/__pycache__").mkdir(parents=True)
    code = "import __spark_entry__ as e; n = e.queries(); print(len(n), any(x.startswith('op') for x in n), set(e.oracle_sql()) == set(n))"
    said = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "rest", capture_output=True, text=True, timeout=120)
    assert said.stdout.split()[1:] == ["False", "True"], said.stderr
    assert not math.isnan(int(said.stdout.split()[0]))
