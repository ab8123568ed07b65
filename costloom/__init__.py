"""costloom: cost attribution on PySpark.

Turns billing usage, price lists, change feeds, query and serving history and
directory exports into priced, attributed and time-comparable spend. Every
operator is a plain ``DataFrame -> DataFrame`` function; reading, writing and
streaming live in ``sources`` and ``streaming``.
"""
