"""Registered queries; importing this package registers all of them."""

from . import imaging, timing, visibility  # noqa: F401
