"""Column-level functions: label, ratio, casts, hashing and vector math."""

from . import columns, vectors

__all__ = ["columns", "vectors"]
