"""Column-level helpers (``Column -> Column``), all JVM-side SQL functions
and higher-order functions so they stay inside whole-stage codegen."""

from tessera.functions.text import *  # noqa: F401,F403
from tessera.functions.arrays import *  # noqa: F401,F403
