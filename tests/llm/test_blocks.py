"""Where documents go: every row in one block, blocks in order or by hash, and no cut points where none are needed."""

import random

import pytest

from tallymark.llm import blocks


def placed(df, ordered, block_bytes=400):
    made = blocks.into_blocks(df, block_bytes, ordered)
    out = {}
    for row in made.rows.collect():
        for has_id, doc_id, key, text, copies in blocks.unpack(row["payload"]):
            out.setdefault(row["block"], []).extend([((has_id, doc_id, key), text)] * copies)
    return made.count, out


@pytest.mark.parametrize("ordered", [True, False])
def test_every_row_is_in_one_block(spark, documents, ordered):
    rng = random.Random(5)
    docs = [(rng.choice([None, -5, *range(80)]), "word " * rng.randrange(12)) for _ in range(400)] + [(7, None), (7, "same")] + [(7, "same")] * 20
    n, found = placed(documents(*docs).repartition(6), ordered)
    assert n > 10 and set(found) <= set(range(n)) and len(found) > n / 2
    rows = sorted((place[1] if place[0] else None, text) for held in found.values() for place, text in held if place[0])
    assert rows == sorted((i, t or "") for i, t in docs if i is not None)
    assert sum(not place[0] for held in found.values() for place, _ in held) == sum(i is None for i, _ in docs)
    # Equal documents share a block.
    homes = {}
    for block, held in found.items():
        for place, _ in held:
            assert homes.setdefault(place, block) == block
    if ordered:
        ordered_places = [sorted(p for p, _ in found[b]) for b in sorted(found)]
        assert all(a[-1] < b[0] for a, b in zip(ordered_places, ordered_places[1:]))


def test_blocks_by_hash_carry_no_cut_points(spark, documents):
    """The plan's closures are the same size for many blocks as for few."""
    df = documents(*[(i, "word " * 20) for i in range(3000)])

    def closure(block_bytes, ordered):
        made = blocks.into_blocks(df, block_bytes, ordered)
        function = made.rows._jdf.queryExecution().analyzed().functionExpr().func().command()
        return made.count, function.size()

    (few, small), (many, large) = closure(100_000, False), closure(300, False)
    assert many > 50 * few and abs(large - small) < 64
    assert closure(300, True)[1] > large + 8 * many
