import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.llm.conftest import ROWS
from tripmart.llm import bpe, token_shards
from tripmart.workspace import new_path

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def written(spark, docs):
    path = new_path(spark, "shards")
    token_shards.write_shards(docs, path, bpe.read_vocabulary(PATH), end_id=1, shard_bytes=40_000)
    return path


def test_round_trip(spark, docs, written):
    rows = sorted(token_shards.read_shards(spark, written).collect(), key=lambda r: r.id)
    library, start = Tokenizer.from_file(PATH), 0
    for r, d in zip(rows, docs.orderBy("doc_id").collect(), strict=True):
        ids = library.encode(d.text, add_special_tokens=False).ids + [1]
        assert (r.id, r.start, r.n_tokens, r.ids) == (d.doc_id, start, len(ids), ids)
        start += len(ids)


def test_a_document_is_read_by_its_offset_alone(spark, written):
    files = spark.read.format("binaryFile").load(f"{written}/shards").where("length > 0").collect()
    dictionary = bytes(spark.read.format("binaryFile").load(f"{written}/dictionary").first().content)[:-1]
    assert len(files) > 1 and len(dictionary) > 1_000
    shard = bytes(files[0].content)
    _, width, index = token_shards.open_shard(shard, dictionary)
    whole = [token_shards.read_document(shard, index, width, dictionary, i) for i in range(len(index))]
    assert [len(x) for x in whole] == index["tokens"].tolist()
    middle = len(index) // 2
    blanked = bytearray(shard)
    blanked[: index["offset"][middle]] = bytes(index["offset"][middle])
    assert np.array_equal(token_shards.read_document(bytes(blanked), index, width, dictionary, middle), whole[middle])
    with pytest.raises(ValueError, match="another dictionary"):
        token_shards.open_shard(shard, b"other")


def test_tricky(spark, tricky, nothing):
    path = new_path(spark, "tricky-shards")
    token_shards.write_shards(tricky, path, bpe.read_vocabulary(PATH))
    rows = token_shards.read_shards(spark, path).orderBy("start", "n_tokens").collect()
    library = Tokenizer.from_file(PATH)
    assert sorted(map(tuple, (r.ids for r in rows))) == sorted(tuple(library.encode(t or "", add_special_tokens=False).ids) for _, t, *_ in ROWS)
    assert [r.id for r in rows if r.id is not None] == sorted(i for i, *_ in ROWS if i is not None)
    path = new_path(spark, "no-shards")
    token_shards.write_shards(nothing, path, bpe.read_vocabulary(PATH))
    assert token_shards.read_shards(spark, path).count() == 0


def test_starts_do_not_depend_on_the_join_nor_on_groups(spark, written):
    plain = {tuple(r) for r in token_shards.read_shards(spark, written).select("id", "start").collect()}
    merged = token_shards.read_shards(spark, written, broadcast_shards=0).select("id", "start")
    assert "SortMergeJoin" in merged._jdf.queryExecution().toString()
    assert {tuple(r) for r in merged.collect()} == plain
    bases = [sorted(map(tuple, token_shards.shard_bases(spark, written, group).collect())) for group in (1, 3, 1_000)]
    assert bases[0] == bases[1] == bases[2] and len(bases[0]) > 3


def test_rows_without_id_and_copies_are_spread(spark):
    rows = spark.range(4_000).selectExpr("CAST(NULL AS BIGINT) AS doc_id", "'the same words for all of them' AS text")
    path = new_path(spark, "hot-shards")
    token_shards.write_shards(rows.repartition(3), path, bpe.read_vocabulary(PATH), shard_bytes=10_000)
    sizes = [r.length for r in spark.read.format("binaryFile").load(f"{path}/shards").where("length > 0").select("length").collect()]
    assert len(sizes) > 3 and max(sizes) < sum(sizes) / 2
    found = token_shards.read_shards(spark, path)
    assert found.count() == 4_000 and found.select("start").distinct().count() == 4_000
