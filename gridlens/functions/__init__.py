"""Column and frame level functions shared by all operators."""
