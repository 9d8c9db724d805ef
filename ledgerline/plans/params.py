"""Parameters of the registered queries over the supplied data.

The supplied orders span 1995-01 .. 2001-08; the window brackets them so that the
strict and zero-filled series differ (empty months at both ends).
"""

WINDOW_START = "1994-10-01"
WINDOW_END = "2002-01-01"

# Derived from the window: leave-one-out candidates are canceled in
# [WINDOW_START + 1 month, WINDOW_END); tier-change pairs need v0 canceled in [WINDOW_START, WINDOW_END].
