import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from bandsaw.operators import kernels as K
from bandsaw.operators.bands import cut_rows
from bandsaw.operators.components import area_test, fill_block, parts_of
from tests.helpers import areas, filled, flood


def row_of(mask):
    return {k: v[0] for k, v in cut_rows(0, mask, mask.shape[0] + 12, 12).items()} | {"chosen": None}


masks = st.tuples(st.integers(1, 14), st.integers(1, 14), st.integers(0, 2**32 - 1), st.floats(0.2, 0.8)).map(
    lambda t: (np.random.default_rng(t[2]).random((t[0], t[1])) < t[3]).astype(np.uint8)
)


@settings(max_examples=60, deadline=None)
@given(masks)
def test_fill_and_labels_equal_flood_fill(mask):
    row = row_of(mask)
    assert (fill_block(row, mask) == filled(mask)).all()
    for value, diagonal in ((1, True), (0, False)):
        parts = parts_of(row, mask, value)
        labels = flood(mask == value, diagonal)
        assert parts.first.size == labels.max()
        for i in range(parts.y.size):
            cells = labels[parts.y[i], parts.x0[i] : parts.x1[i] + 1]
            first = np.flatnonzero((labels == cells[0]).ravel())[0]
            assert (cells == cells[0]).all() and parts.first[parts.of_run[i]] == first


@settings(max_examples=40, deadline=None)
@given(masks, st.floats(0, 20))
def test_area_filter_equals_window_rule(mask, limit):
    labels = flood(mask, diagonal=True)
    expected = np.zeros_like(mask)
    for first, area in areas(mask).items():
        if area > limit:
            expected |= (labels == labels.ravel()[first]).astype(np.uint8)
    assert (area_test(row_of(mask), mask, limit) == expected).all()


@pytest.mark.parametrize(("w", "h"), [(1, 1), (2, 5), (7, 4)])
def test_box_area_goes_through_pixel_centres(w, h):
    mask = np.zeros((10, 10), np.uint8)
    mask[1 : 1 + h, 2 : 2 + w] = 1
    assert list(areas(mask).values()) == [(w - 1) * (h - 1)]


@settings(max_examples=40, deadline=None)
@given(masks)
def test_morphology_properties(mask):
    mask = mask * np.uint8(255)
    frame = (True, True)
    opened = K.dilate5(K.erode5(mask, *frame), *frame)
    closed = K.erode5(K.dilate5(mask, *frame), *frame)
    assert (opened <= mask).all() and (mask <= closed).all()
    assert (K.dilate5(K.erode5(opened, *frame), *frame) == opened).all()
    assert (K.erode5(K.dilate5(closed, *frame), *frame) == closed).all()
    padded = np.pad(mask, 2)
    expected = np.max([padded[i : i + mask.shape[0], j : j + mask.shape[1]] for i in range(5) for j in range(5)], axis=0)
    assert (K.dilate5(mask, *frame) == expected).all()


def test_blur_equals_direct_sum():
    a = np.random.default_rng(1).integers(0, 256, (9, 7, 3)).astype(np.uint8)
    k = np.array([1, 4, 6, 4, 1])
    p = np.pad(a, [(2, 2), (2, 2), (0, 0)], mode="reflect").astype(int)
    total = sum(k[i] * k[j] * p[i : i + 9, j : j + 7] for i in range(5) for j in range(5))
    assert (K.gaussian5(a, True, True) == ((total + 128) >> 8)).all()


def test_known_colours():
    bgr = np.array([[[0, 0, 0], [255, 255, 255], [0, 0, 255], [0, 255, 0], [255, 0, 0]]], np.uint8)
    lab = K.lab(bgr)[0].tolist()
    assert lab == [[0, 128, 128], [255, 128, 128], [136, 208, 195], [224, 42, 211], [82, 207, 20]]
    assert K.gray(bgr)[0].tolist() == [0, 255, 76, 150, 29]


def test_lab_round_trip_is_close():
    bgr = np.random.default_rng(2).integers(0, 256, (20, 20, 3)).astype(np.uint8)
    back = K.lab_to_bgr(K.lab(bgr)).astype(int)
    assert np.abs(back - bgr).mean() < 3


@pytest.mark.parametrize("shape", [(20, 20), (300, 300)])
def test_histogram_counts_every_pixel(shape):
    a = np.random.default_rng(3).integers(0, 4, (*shape, 3)).astype(np.uint8)
    c0, c1, c2, w = K.histogram(a)
    values, counts = np.unique(a.reshape(-1, 3), axis=0, return_counts=True)
    assert (np.stack([c0, c1, c2], axis=1) == values).all() and (w == counts).all()


def test_fixed_tables_are_made_once():
    from bandsaw.operators import kernels

    assert kernels._linear_light() is kernels._linear_light()
    assert kernels._reflected(9, 2, 0) is kernels._reflected(9, 2, 0)
