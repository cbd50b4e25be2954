from bidlens.functions.expressions import (  # noqa: F401
    hash_unit, mean_of, nation_code, safe_ratio, supplier_key,
)
from bidlens.functions.predicates import not_in, null_safe_join  # noqa: F401
from bidlens.functions.sketches import estimate, merged, sketch_of  # noqa: F401
