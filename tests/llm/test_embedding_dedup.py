import numpy as np
import pytest

from proofmill.llm import embedding_dedup as e


def brute(rows, threshold):
    vectors = []
    for _, label, x in rows:
        ok = label is not None and x and None not in x and np.isfinite(np.array(x, float)).all() and any(x)
        vectors.append(np.array(x, float) / np.linalg.norm(x) if ok else None)
    n = len(rows)
    linked = [[j for j in range(n) if j != i and vectors[i] is not None and vectors[j] is not None and rows[i][1] == rows[j][1] and len(vectors[i]) == len(vectors[j]) and vectors[i] @ vectors[j] >= threshold] for i in range(n)]
    group = list(range(n))
    for _ in range(n):
        group = [min([group[i], *[group[j] for j in linked[i]]]) for i in range(n)]
    first = {}
    for i, (v, *_) in enumerate(rows):
        if v is not None:
            first[group[i]] = min(v, first.get(group[i], v))
    return sorted(((v, len(linked[i]), None if v is None else first[group[i]]) for i, (v, *_) in enumerate(rows)), key=repr)


def data(d, seed):
    rng = np.random.default_rng(seed)
    rows, n = [], 0
    for k in range(12):
        base = rng.normal(size=d)
        for _ in range(10):
            x = (base + rng.normal(size=d) * rng.choice([0.0, 0.1, 0.18])) * rng.choice([1, 3])
            rows.append((n, k % 3 if k else None, [float(np.float32(v)) for v in x]))
            n += 1
    return rows


@pytest.mark.parametrize(("d", "tile", "block"), [(24, 512, 8), (24, 2, 3), (24, 8, 1), (3, 16, 8), (1, 16, 8)])
def test_links_equal_brute_force(make, monkeypatch, d, tile, block):
    monkeypatch.setattr(e, "BLOCK", block)
    rows = data(d, d) + [(900, 1, None), (901, 1, [0.0] * d), (902, 1, [float("nan")] * d), (903, 1, [None] * d), (904, 1, []), (905, 1, [1.0] * (d + 1)), (906, 1, [1.0] * (d + 1)), (None, 1, [1.0] * (d + 1))]
    rows += [rows[15], rows[15]]  # repeated rows
    got = e.link_vectors(make(rows, "vec_id long, label int, embedding array<float>"), tile=tile)
    assert sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in got.collect()), key=repr) == brute(rows, 0.98)


def test_tiles_stop_early_and_lose_nothing():
    rng = np.random.default_rng(5)
    a = rng.normal(size=(60, 32)) * np.linspace(3, 0.1, 32)
    b = np.concatenate([a[:20] + rng.normal(size=(20, 32)) * 0.1, rng.normal(size=(30, 32))])
    a, b = (x / np.linalg.norm(x, axis=1, keepdims=True) for x in (a, b))
    turned = np.linalg.qr(rng.normal(size=(32, 32)))[0]
    for rotation in (np.eye(32), turned):
        for threshold in (0.5, 0.9, 0.98):
            assert np.array_equal(e.compare_tiles(a, b, rotation, threshold, False), a @ b.T >= threshold)


def test_the_plain_product_decides():
    """Pairs exactly at the threshold, rotated in any way: what the plain unit vectors give counts."""
    rng = np.random.default_rng(7)
    a = rng.normal(size=(40, 16))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = a + rng.normal(size=a.shape) * 0.05
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    plain = np.einsum("nd,nd->n", a, b)
    for k in range(40):
        turned = np.linalg.qr(rng.normal(size=(16, 16)))[0]
        assert e.compare_tiles(a[k : k + 1], b[k : k + 1], turned, plain[k], False)[0, 0]
        assert not e.compare_tiles(a[k : k + 1], b[k : k + 1], turned, np.nextafter(plain[k], 2), False)[0, 0]


def test_dense_cell_of_many_blocks(make, monkeypatch):
    """One near-copy group that is cut into many tiles and blocks."""
    monkeypatch.setattr(e, "BLOCK", 2)
    rng = np.random.default_rng(3)
    base = rng.normal(size=12)
    rows = [(i, 1, [float(np.float32(v)) for v in base + rng.normal(size=12) * 0.02]) for i in range(150)]
    got = e.link_vectors(make(rows, "vec_id long, label int, embedding array<float>"), tile=6).collect()
    assert sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in got), key=repr) == brute(rows, 0.98)


def test_empty_table(make):
    assert e.link_vectors(make([], "vec_id long, label int, embedding array<float>")).count() == 0
