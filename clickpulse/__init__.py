"""clickpulse: shop clickstream analytics as plain Spark DataFrame operators.

Every public operator is a ``DataFrame -> DataFrame`` function built on the
DataFrame / SQL / Structured Streaming APIs. Nothing here creates a session
except :func:`clickpulse.session.build_session`, which tests and the bench use.
"""

__version__ = "0.1.0"
