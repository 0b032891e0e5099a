"""Connected components for the deduplication operators."""

from ..operators.components import connected_components

__all__ = ["connected_components"]
