"""Operators for preparing training text at scale.

Nothing else in the package imports this subpackage; it may import the
package's general helpers (session, scratch folders, materialising).
"""
