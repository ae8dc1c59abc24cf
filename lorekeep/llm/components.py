"""Connected components, as the library has them; here so that the operators name one place."""

from lorekeep.operators.components import components

__all__ = ["components"]
