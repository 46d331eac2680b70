"""Operators for preparing training text, one module each.

Nothing outside this package imports it. ``queries`` binds every operator to the
test tables; ``store`` keeps intermediate frames in the shared folder.
"""
