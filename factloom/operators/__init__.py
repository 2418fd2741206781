"""Graph operators: matching, closure, integrity, queries and fact extraction."""
