"""Incremental change impact over a stream of landed diffs.

The analysed tool has no streaming; this package only lets the same
change-impact operator run as new diffs land, instead of re-running over
all history.  Each diff row holds a whole change, so every micro-batch
is complete for the changes it carries: no watermark or state is needed.
"""
