"""ratingsmith: rating-event analytics expressed as Spark DataFrame operators.

Every operator is a function DataFrame -> DataFrame whose column names are
parameters.  Nothing is collected to the driver except bounded scalars.
"""

__version__ = "0.1.0"
