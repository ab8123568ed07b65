"""Dataflow operators: ``DataFrame`` in, ``DataFrame`` out, no actions hidden inside
unless the docstring says so."""
