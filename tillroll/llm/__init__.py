"""Training-data operators: thirteen corpus operators and the queries built on them.

Nothing outside this folder imports it; the folder can be removed and the rest
of the package keeps working.
"""
