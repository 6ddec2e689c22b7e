"""Column -> Column building blocks (all JVM built-ins, no Python UDFs)."""

from lateline.functions.columns import *  # noqa: F401,F403
from lateline.functions.buckets import *  # noqa: F401,F403
