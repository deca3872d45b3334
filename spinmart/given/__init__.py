"""The given test tables read in the shape of the source tables, with queries and their check SQL."""
