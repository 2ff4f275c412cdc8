"""Column helpers and the distributed building blocks shared by the operators."""
