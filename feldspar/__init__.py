"""feldspar: feature engineering and model validation on Spark DataFrames."""

from feldspar.session import local_session

__all__ = ["local_session"]
