"""The driver tables read as device exports, and the registered queries."""
