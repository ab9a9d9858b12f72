"""Runnable queries over the given tables; importing the package registers all of them."""

from annoframe.plans import datasets, detection, files, live, models, motion, shapes, streams  # noqa: F401
