import numpy as np
import pyarrow as pa
from hypothesis import given
from hypothesis import strategies as st

from tidemark.llm.words import Ranges, _hash_words, blocks, grouped, shingle_hashes, sliding

TEXT = st.text(alphabet=st.sampled_from(list("ab é\t\n\x0b\x0c\r 漢")), max_size=30)


@given(st.lists(st.none() | TEXT, max_size=12), st.integers(1, 40))
def test_words_are_runs_without_ascii_white_space(texts, block_bytes):
    known, rows = {}, 0
    for block in blocks(pa.array(texts, pa.string()), block_bytes):
        for at, row in enumerate(block.rows):
            words = (texts[row] or "").encode().split()
            hashes = block.hashes[block.first[at] : block.first[at + 1]]
            assert len(words) == len(hashes)
            for word, value in zip(words, hashes, strict=True):
                assert known.setdefault(word, value) == value
            rows += 1
    assert rows == len(texts) and len(set(known.values())) == len(known)


@given(st.lists(st.integers(0, 3), min_size=1, max_size=30), st.integers(1, 8))
def test_ranges_and_sliding(values, width):
    values = np.array(values, dtype=np.uint64)
    ranges, seen = Ranges(values), {}
    for start in range(len(values)):
        for end in range(start + 1, len(values) + 1):
            value = ranges.of(np.array([start]), np.array([end]))[0]
            assert seen.setdefault(tuple(values[start:end]), value) == value
    if len(values) >= width:
        lowest = [values[at : at + width].min() for at in range(len(values) - width + 1)]
        assert list(sliding(values, width, np.minimum)) == lowest


def test_a_short_text_is_one_shingle():
    (block,) = blocks(pa.array(["a b", "", "a b c d", None, "a b c"]))
    values, owner = shingle_hashes(block, 3)
    assert list(owner) == [0, 2, 2, 4] and values[1] == values[3] and len(set(values)) == 3


@given(st.lists(st.integers(0, 5), max_size=30), st.lists(st.integers(1, 4), min_size=30, max_size=30))
def test_groups_are_never_cut(keys, sizes):
    keys, batches = sorted(keys), []
    rest = list(keys)
    for size in sizes:
        batches.append(pa.record_batch({"k": pa.array(rest[:size], pa.int64())}))
        rest = rest[size:]
    found = [table.column("k").to_pylist() for table in grouped(batches, "k")]
    assert [key for part in found for key in part] == keys
    for one, other in zip(found, found[1:], strict=False):
        assert one[-1] != other[0]


@given(st.lists(st.integers(1, 9), min_size=1, max_size=20), st.integers(1, 12))
def test_hashes_do_not_depend_on_the_portions(lengths, at_once):
    ends = np.cumsum(np.array(lengths) + 1) - 1
    starts = ends - np.array(lengths)
    data = np.random.Generator(np.random.PCG64(1)).integers(0, 255, ends[-1]).astype(np.uint8)
    assert (_hash_words(data, starts, ends, at_once) == _hash_words(data, starts, ends)).all()
