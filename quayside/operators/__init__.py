from quayside.operators import core, manufacturing, purchase, sale, shop, stock  # noqa: F401
from quayside.operators.registry import EXPORTS, compatible, export, exports, left_out

__all__ = ["EXPORTS", "compatible", "export", "exports", "left_out"]
