"""Training-data operators.

One module per operator; nothing in the rest of the library imports this
subpackage.  ``entries`` lists the queries that the driver registers.
"""
