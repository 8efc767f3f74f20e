"""Looking up a path inside nested values."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, functions as F, types as T


# Spark's path syntax has three spellings for a field and no escapes.
_SPELLINGS = (("['{}']", re.compile(r"[^'?]+")), ('["{}"]', re.compile(r'[^"?]+')), (".{}", re.compile(r"[^.\[]+")))


def variant_path(keys: Sequence[str | int]) -> str:
    """JSON path of a list of keys; text keys name fields, integers name list items."""
    steps = []
    for key in keys:
        if isinstance(key, int):
            steps.append(f"[{key}]")
            continue
        spelled = next((text.format(key) for text, fits in _SPELLINGS if fits.fullmatch(key)), None)
        if spelled is None:
            raise KeyError(f"key {key!r} cannot be written as a path")
        steps.append(spelled)
    return "$" + "".join(steps)


def nested_value(col: Column, dtype: T.DataType, keys: Sequence[str | int], as_type: str = "variant") -> Column:
    """Value at ``keys`` inside a struct, map, array, variant or JSON text; null where absent.

    Structs, maps and arrays are walked as long as the type says how; whatever is left of
    the path is looked up in the variant or JSON text reached by then.
    """
    for step, key in enumerate(keys):
        if isinstance(dtype, T.StructType):
            if key not in dtype.names:
                raise KeyError(f"nothing at key path {' -> '.join(map(str, keys[: step + 1]))}")
            col, dtype = col.getField(key), dtype[key].dataType
        elif isinstance(dtype, T.MapType):
            col, dtype = F.try_element_at(col, F.lit(key)), dtype.valueType
        elif isinstance(dtype, T.ArrayType):
            col, dtype = F.get(col, F.lit(int(key))), dtype.elementType
        elif isinstance(dtype, (T.VariantType, T.StringType)):
            whole = col if isinstance(dtype, T.VariantType) else F.try_parse_json(col)
            return F.try_variant_get(whole, variant_path(keys[step:]), as_type)
        else:
            raise KeyError(f"nothing at key path {' -> '.join(map(str, keys[: step + 1]))}")
    return col
