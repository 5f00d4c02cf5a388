"""The driver tables read as shop-floor roles, the registered queries and their SQL twins."""
