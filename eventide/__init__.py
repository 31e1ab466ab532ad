"""eventide: event-time stream analytics written as Spark DataFrame / SQL /
Structured Streaming code.

Every analytic is a ``DataFrame -> DataFrame`` function.  Stateless, window
and join analytics accept streaming inputs unchanged; sequential per-key
analytics (alerts, matching, running counts) have an exact batch form built on
the skew-safe keyed scan in :mod:`eventide.operators.scan` and a streaming form
built on ``transformWithStateInPandas`` in :mod:`eventide.streaming`.
"""

__version__ = "0.1.0"
