"""One BLAS thread a task: Spark gives each task a core, and waiting threads of small products burn the others."""

from __future__ import annotations

import ctypes
import re
from functools import cache

# fixed values: the setters of the library numpy may be linked with
_SETTERS = ("scipy_openblas_set_num_threads64_", "scipy_openblas_set_num_threads", "openblas_set_num_threads64_",
            "openblas_set_num_threads")


@cache
def one_thread() -> bool:
    """Limits the BLAS that numpy has loaded into this process to one thread; False if it cannot be found."""
    import numpy  # noqa: F401  (loads the library)

    try:
        with open("/proc/self/maps") as f:
            paths = sorted({m.group(0) for m in re.finditer(r"/\S*openblas\S*\.so\S*", f.read())})
    except OSError:
        return False
    done = False
    for path in paths:
        lib = ctypes.CDLL(path)
        for name in _SETTERS:
            if hasattr(lib, name):
                getattr(lib, name)(ctypes.c_int(1))
                done = True
                break
    return done
