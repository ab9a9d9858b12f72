"""Properties of the pixel ops that are not compared byte for byte."""

from __future__ import annotations

import numpy as np

from annoframe.operators.pixels import Counter, apply_op, resized, to_array, to_struct
from annoframe.operators.transforms import Op

RNG = np.random.default_rng(0)
IMAGE = RNG.integers(0, 256, (12, 10, 3)).astype(np.uint8)


def run(op: Op, amount: float = 0.0, image: np.ndarray = IMAGE, seed: int = 1) -> np.ndarray:
    return apply_op(image, op, {"amount": amount}, Counter(seed, 1, 1, 0))


def test_struct_round_trip():
    assert (to_array(to_struct(IMAGE)) == IMAGE).all()


def test_blur_keeps_flat_images_and_size_and_lowers_contrast():
    flat = np.full((9, 7, 3), 77, np.uint8)
    assert (run(Op("blur"), 2.0, flat) == flat).all()
    assert (run(Op("blur"), 0.0) == IMAGE).all()
    blurred = run(Op("blur"), 2.0)
    assert blurred.shape == IMAGE.shape and blurred.std() < IMAGE.std()


def test_noise_is_fixed_by_its_seed_and_off_at_zero():
    assert (run(Op("noise"), 0.0) == IMAGE).all()
    assert (run(Op("noise"), 0.08) == run(Op("noise"), 0.08)).all()
    assert (run(Op("noise"), 0.08) != run(Op("noise"), 0.08, seed=2)).any()


def test_hue_keeps_greys_and_brightness():
    grey = np.repeat(IMAGE[..., :1], 3, -1)
    assert (run(Op("hue_shift"), 90.0, grey) == grey).all()
    assert (run(Op("hue_shift"), 90.0).max(-1) == IMAGE.max(-1)).all()


def test_cut_out_fills_rectangles_only():
    out = run(Op("cutout", low=0.1, high=0.3, extra={"count": 1}))
    changed = (out != IMAGE).any(-1)
    assert changed.any() and (out[changed] == 128).all()
    assert (run(Op("cutout", extra={"count": 0})) == IMAGE).all()


def test_resize_mixes_neighbours_and_keeps_flat_images():
    flat = np.full((9, 7, 3), 77, np.uint8)
    assert (resized(flat, 20, 3) == 77).all() and resized(flat, 20, 3).shape == (3, 20, 3)
    assert (resized(IMAGE, 10, 12) == IMAGE).all()
    ramp = np.repeat(np.array([[0, 100]], np.uint8)[..., None], 3, -1)
    assert resized(ramp, 4, 1)[0, :, 0].tolist() == [0, 25, 75, 100]
    assert resized(ramp, 1, 1)[0, 0, 0] == 50


def test_counter_numbers_are_even_and_do_not_repeat():
    u = Counter(3, 5, 1, 0).uniform(np.arange(100_000))
    assert 0 < u.min() and u.max() < 1 and abs(u.mean() - 0.5) < 0.01 and len(np.unique(u)) > 99_900
    n = Counter(3, 5, 1, 0).normal(100_000)
    assert abs(n.mean()) < 0.02 and abs(n.std() - 1) < 0.02
    assert abs(np.corrcoef(u[1:], u[:-1])[0, 1]) < 0.02
