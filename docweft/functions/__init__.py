"""Column functions: strings in, columns out; no Python workers unless named kernels."""
