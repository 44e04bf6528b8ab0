"""League analytics on Spark: stage raw match files and answer questions over any league and seasons."""

from touchline.scope import Scope

__all__ = ["Scope"]
