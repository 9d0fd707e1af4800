"""Connected components, as the contract rules have them."""

from contractlens.operators.components import connected_components

__all__ = ["connected_components"]
