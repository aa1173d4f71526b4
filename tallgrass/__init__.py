"""tallgrass: labour-market, education and enrollment reporting on Spark.

Marts, reusable DataFrame operators, the wide-sheet reshaping job and the
data-operations layer, all expressed as Spark DataFrame / SQL work.
"""

from tallgrass.config import MartConfig
from tallgrass.session import get_session, scratch_root

__all__ = ["MartConfig", "get_session", "scratch_root"]
