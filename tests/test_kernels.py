"""Image kernels against plain definitions."""

import math

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from skyframes.operators import kernels, stencil
from skyframes.operators.edges import edge_flags
from skyframes.operators.kernels import fill, largest


@st.composite
def binary(draw, side=9):
    high, wide = draw(st.integers(1, side)), draw(st.integers(1, side))
    bits = draw(st.lists(st.booleans(), min_size=high * wide, max_size=high * wide))
    return np.array(bits, bool).reshape(high, wide)


def flood(image, steps):
    """Component of each foreground pixel as the smallest position, by search."""
    label = -np.ones(image.shape, int)
    high, wide = image.shape
    for y, x in zip(*np.nonzero(image)):
        if label[y, x] >= 0:
            continue
        name, todo = y * wide + x, [(y, x)]
        label[y, x] = name
        while todo:
            cy, cx = todo.pop()
            for dy, dx in steps:
                ny, nx = cy + dy, cx + dx
                if 0 <= ny < high and 0 <= nx < wide and image[ny, nx] and label[ny, nx] < 0:
                    label[ny, nx] = name
                    todo.append((ny, nx))
    return label


FOUR = [(0, 1), (1, 0), (0, -1), (-1, 0)]
EIGHT = FOUR + [(1, 1), (1, -1), (-1, 1), (-1, -1)]


def labels(image, reach):
    start, length, part = kernels.components(image, reach)
    out = -np.ones(image.size, int)
    pos, run = kernels.spread_runs(start, length)
    out[pos] = start[part][run]
    return out.reshape(image.shape)


@given(binary())
@settings(max_examples=150, deadline=None)
def test_components_equal_flood(image):
    assert (labels(image, 1) == flood(image, EIGHT)).all()
    assert (labels(image, 0) == flood(image, FOUR)).all()


@given(binary())
@settings(max_examples=150, deadline=None)
def test_fill_keeps_what_reaches_the_border(image):
    back = flood(~image, FOUR)
    border = np.zeros(image.shape, bool)
    border[[0, -1]] = border[:, [0, -1]] = True
    open_labels = set(back[border]) - {-1}
    assert (fill(image) == ~np.isin(back, list(open_labels) or [-2])).all()


@given(binary(), st.sampled_from([3, 5]))
@settings(max_examples=150, deadline=None)
def test_sweep_is_the_clipped_window(image, size):
    r = size // 2
    eroded, grown = kernels.sweep(image, size, np.minimum), kernels.sweep(image, size, np.maximum)
    for y in range(image.shape[0]):
        for x in range(image.shape[1]):
            window = image[max(0, y - r) : y + r + 1, max(0, x - r) : x + r + 1]
            assert eroded[y, x] == window.all() and grown[y, x] == window.any()
    assert (eroded <= image).all() and (image <= grown).all()


@given(binary(), st.integers(0, 5), st.integers(0, 5), st.integers(0, 5), st.integers(0, 5))
@settings(max_examples=200, deadline=None)
def test_cut_out_equals_whole_frame(image, above, below, left, right):
    frame = np.pad(image, ((above, below), (left, right)))
    steps = (stencil.dilate(3), fill, stencil.erode(3), largest, stencil.dilate(5), fill)
    whole = frame
    for step in steps:
        whole = step(whole)
    part, top, side = stencil.run_steps(np.flatnonzero(frame), *frame.shape, steps)
    pos = stencil.frame_positions(np.flatnonzero(part), part.shape[1], top, side, frame.shape[1])
    assert pos.tolist() == np.flatnonzero(whole).tolist()


def test_smoothing_by_definition():
    image = np.random.default_rng(1).integers(0, 256, (7, 6)).astype(np.int32)
    got = kernels.smooth(image)
    for y in range(7):
        for x in range(6):
            num = den = 0.0
            for dy in range(-2, 3):
                for dx in range(-2, 3):
                    if dy * dy + dx * dx <= 4 and 0 <= y + dy < 7 and 0 <= x + dx < 6:
                        t = int(image[y + dy, x + dx])
                        w = math.exp(-(dy * dy + dx * dx + (t - int(image[y, x])) ** 2) / 5000)
                        num, den = num + w * t, den + w
            assert got[y, x] == math.floor(round(num / den, 6) + 0.5)


def test_flat_image_has_no_ridge_and_a_step_has_one():
    assert not kernels.ridges(*kernels.derivatives(np.full((5, 5), 9))).any()
    step = np.zeros((5, 8), np.int32)
    step[:, 4:] = 100
    ridge = kernels.ridges(*kernels.derivatives(step))
    assert (ridge[:, 3] == 400).all() and (np.count_nonzero(ridge, axis=1) == 1).all()


@given(st.lists(binary(6), min_size=1, max_size=4), st.booleans())
@settings(max_examples=150, deadline=None)
def test_stacks_are_their_images(images, turned):
    """A stack gives what its images give one by one, whatever its order in memory."""
    shape = tuple(max(i.shape[k] for i in images) for k in (0, 1))
    stack = np.stack([np.pad(i, ((0, shape[0] - i.shape[0]), (0, shape[1] - i.shape[1]))) for i in images])
    if turned:
        stack = np.asfortranarray(stack)
    assert (kernels.fill_each(stack) == np.stack([fill(i) for i in stack])).all()
    assert (kernels.largest_each(stack) == np.stack([largest(i) for i in stack])).all()
    image, start, length, label, area = kernels.parts_of(stack)
    assert (kernels.drawn(stack.shape, image, start, length) == stack).all()
    rank = kernels.ranks(image, label, area)
    for k, one in enumerate(stack):
        first, size, part = kernels.components(one, 1)
        total = np.bincount(part, size, minlength=len(first)).astype(int)
        order = sorted(set(part), key=lambda p: (-total[p], p))
        assert [order.index(p) for p in part] == rank[image == k].tolist()
    run_image, run_start, run_length = kernels.flat_runs(stack)
    assert (kernels.drawn(stack.shape, run_image, run_start, run_length) == stack).all()


def test_hysteresis_links_within_an_image():
    rng = np.random.default_rng(2)
    magnitude = rng.choice([0, 50, 120, 250], (5, 9, 8), p=[0.4, 0.2, 0.35, 0.05])
    got = kernels.linked_edges(magnitude, 100, 200)
    for k in range(5):
        label = flood(magnitude[k] > 100, EIGHT)
        strong = set(label[magnitude[k] > 200])
        assert (got[k] == np.isin(label, list(strong - {-1}))).all()
    assert not kernels.linked_edges(np.full((2, 3, 3), 150), 100, 200).any()


def test_a_batch_goes_back_in_pieces():
    """What a task makes of a batch is bounded by a piece, or by one frame that is larger."""
    sizes = np.array([5, 0, 5, 30, 1, 1, 0, 9, 9])
    pieces = list(stencil._pieces(sizes, 10))
    assert [i for p in pieces for i in range(p.start, p.stop)] == list(range(len(sizes)))
    assert all(sizes[p].sum() <= 20 or p.stop - p.start <= 2 for p in pieces) and len(pieces) > 3
    assert list(stencil._pieces(np.zeros(0, np.int64), 10)) == []


def test_pixel_passes_give_no_whole_batches(spark, sf_dir):
    """Pixels, smoothing and ridges leave a task in pieces, and the scene is built without functions of array elements."""
    from skyframes.catalog.queries import QUERIES
    from skyframes.catalog.views import scene_images

    for name in ("p08_luma_hue", "w03_bilateral", "w04_gradient_nms"):
        plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
        assert "MapInArrow" in plan and "ArrowEvalPython" not in plan, plan
    assert "lambda" not in scene_images(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()


def test_edges_of_a_stack_are_those_of_its_images():
    rng = np.random.default_rng(8)
    for high, wide in ((1, 1), (1, 7), (9, 2), (24, 24), (40, 31)):
        grey = rng.integers(0, 6, (30, high, wide), np.int32) * 51
        smooth = kernels.smooth(grey)
        slopes = kernels.derivatives(smooth)
        every = kernels.ridges(*slopes)
        some = kernels.ridges(*slopes, 100)
        assert np.array_equal(some, np.where(every > 100, every, 0))
        edges = kernels.linked_edges(some, 100, 200)
        for i in range(len(grey)):
            assert np.array_equal(kernels.smooth(grey[i]), smooth[i])
            assert np.array_equal(kernels.ridges(*(s[i] for s in slopes)), every[i])
            assert np.array_equal(kernels.linked_edges(every[i : i + 1], 100, 200)[0], edges[i])


def test_weights_are_looked_up_at_no_negative_place():
    """Signs of differences of noisy pixels are as good as random, and a branch on each made smoothing twice as slow."""
    d = np.arange(-kernels._OUTSIDE - 255, kernels._OUTSIDE + 256)
    at = d + kernels._MOST
    assert at.min() >= 0 and at.max() < len(kernels._APART) and (kernels._APART[at] == d).all()
    assert (kernels._CLOSENESS[at] == np.where(abs(d) < 256, np.exp(-(d**2.0) / kernels.SPREAD), 0)).all()


def test_edges_are_found_in_narrow_whole_numbers(monkeypatch):
    """Magnitudes of 16 bits give the edges that those of 32 bits give."""
    bgr = np.random.default_rng(8).integers(0, 256, (6, 15, 13, 3)).astype(np.uint8)
    bgr[3:, 4:9] //= 40
    wide = kernels.ridges(*kernels.derivatives(kernels.smooth(kernels.grey(bgr))), 100)
    kinds, real = [], kernels.linked_edges
    monkeypatch.setattr(kernels, "linked_edges", lambda found, *limits: kinds.append(found.dtype) or real(found, *limits))
    assert (edge_flags(bgr, 100, 200) == real(wide, 100, 200)).all()
    assert kinds == [np.int16]
