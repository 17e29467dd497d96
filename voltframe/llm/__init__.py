"""Training-data operators: text quality, de-duplication, search, mixing and
packing over document, embedding and page tables. Nothing else in the package
imports this subpackage."""
