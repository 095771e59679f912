from colfit.functions import activations, kernels, losses, numeric, transforms

__all__ = ["activations", "kernels", "losses", "numeric", "transforms"]
