"""Arrays of numbers as numpy matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def finite_rows(column: pa.Array, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and values (double) of the vectors of ``length`` components, none of them null, infinite or not a number."""
    fits = pc.fill_null(pc.equal(pc.list_value_length(column), length), False)
    places = np.flatnonzero(fits.to_numpy(zero_copy_only=False))
    values = column.filter(fits).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, length)
    whole = np.isfinite(values).all(axis=1)
    return places[whole], values[whole]
