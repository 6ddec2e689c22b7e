"""Writers: schema enforcement, snapshots, staged publish, quality report."""

from lateline.sinks.writers import *  # noqa: F401,F403
