"""Operators of a training-data pipeline, one module per operator.

Shared rules, stated once:

* A null text counts as an empty one; rows whose id is null are answered too.
* Input tables may have any further columns. They are never read by name, so a
  column that is called like one of an operator's own cannot disturb it.
* Words are maximal runs of characters outside ``[\\x20\\x09-\\x0D]``.
* Tables that a job reads more than once are written below the folder that
  ``spark.checkpoint.dir`` names (see ``cartwright.runtime``).

Nothing outside this package imports it.
"""
