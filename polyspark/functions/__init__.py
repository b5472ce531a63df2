"""Column functions and join / ranking helpers shared by the operators."""
