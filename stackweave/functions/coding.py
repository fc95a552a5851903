"""Sparse coding of a batch of frames against a few atoms: numpy on one Arrow batch."""

from __future__ import annotations

import numpy as np


def lasso_codes(gram: np.ndarray, cov: np.ndarray, alpha: float, n_iter: int = 200, positive: bool = False, tol: float = 1e-10) -> np.ndarray:
    """Codes minimising ``0.5 |x - c D|^2 + alpha |c|_1``, each until its own code rests.

    Coordinate descent on the Gram form; ``cov`` is ``(frames, atoms)``.
    """
    codes = np.zeros_like(cov)
    size = np.diag(gram)
    # Each frame stops on its own, so its code does not depend on the frames it shares a batch with.
    live = np.arange(len(cov))
    for _ in range(n_iter):
        if not len(live):
            break
        now, moved = codes[live], np.zeros(len(live))
        for j in np.nonzero(size > 1e-12)[0]:
            pull = cov[live, j] - now @ gram[:, j] + size[j] * now[:, j]
            if positive:
                new = np.maximum(pull - alpha, 0.0) / size[j]
            else:
                new = np.sign(pull) * np.maximum(np.abs(pull) - alpha, 0.0) / size[j]
            moved = np.maximum(moved, np.abs(new - now[:, j]))
            now[:, j] = new
        codes[live] = now
        live = live[moved >= tol]
    return codes


def omp_codes(gram: np.ndarray, cov: np.ndarray, k: int, squares: np.ndarray | None = None, tol: float | None = None) -> np.ndarray:
    """Orthogonal matching pursuit with at most ``k`` atoms per frame.

    With ``tol`` a frame also stops once the square of its residual is ``tol`` or less; ``squares`` are the
    frames' own squares then.

    The inverse of the chosen atoms' Gram matrix grows by one row and column per step, so a step costs
    the square of the number chosen. A frame stops when no atom pulls any more, or the strongest one is
    a combination of those it has.
    """
    codes = np.zeros_like(cov)
    live = np.arange(len(cov))
    chosen, inverse = np.zeros((len(cov), 0), dtype=int), np.zeros((len(cov), 0, 0))
    for _ in range(min(k, cov.shape[1])):
        if tol is not None:
            # What is left is square to the chosen atoms, so its square follows from codes and products.
            far = squares[live] - (codes[live] * cov[live]).sum(axis=1) > tol
            live, chosen, inverse = live[far], chosen[far], inverse[far]
            if not len(live):
                break
        pull = np.abs(cov[live] - codes[live] @ gram)
        np.put_along_axis(pull, chosen, -1.0, axis=1)
        best = pull.argmax(axis=1)
        beside = gram[chosen, best[:, None]]
        along = np.einsum("mij,mj->mi", inverse, beside)
        own = gram[best, best]
        fresh = own - (beside * along).sum(axis=1)
        more = (pull[np.arange(len(live)), best] > 1e-12) & (fresh > 1e-10 * own)
        live, best, chosen, inverse, along, fresh = live[more], best[more], chosen[more], inverse[more], along[more], fresh[more]
        if not len(live):
            break
        size = chosen.shape[1]
        grown = np.empty((len(live), size + 1, size + 1))
        grown[:, :size, :size] = inverse + along[:, :, None] * along[:, None, :] / fresh[:, None, None]
        grown[:, :size, size] = grown[:, size, :size] = -along / fresh[:, None]
        grown[:, size, size] = 1 / fresh
        chosen, inverse = np.hstack([chosen, best[:, None]]), grown
        solved = np.einsum("mij,mj->mi", inverse, np.take_along_axis(cov[live], chosen, axis=1))
        block = np.zeros((len(live), cov.shape[1]))
        np.put_along_axis(block, chosen, solved, axis=1)
        codes[live] = block
    return codes


def lasso_path(gram: np.ndarray, cov: np.ndarray, alpha: float = 0.0, positive: bool = False) -> list[tuple[float, np.ndarray]]:
    """The lasso's solutions of one frame as its weight falls to ``alpha``: ``(weight, codes)`` at every knot.

    Codes are linear in the weight between knots (least angles with the lasso's condition). At a knot an atom joins, as
    its pull reaches the common one, or leaves, as its code reaches zero. The inverse of the active atoms' Gram matrix
    grows and shrinks by one row and column; an atom that is a combination of the active ones never joins.
    """
    k = len(cov)
    codes, active, signs, inverse = np.zeros(k), [], [], np.zeros((0, 0))
    barred = np.diag(gram) <= 1e-12
    pull = cov.astype(float)
    strength = pull if positive else np.abs(pull)
    weight = float(np.where(barred, -np.inf, strength).max(initial=-np.inf))
    if weight <= max(alpha, 0.0):
        return [(max(alpha, 0.0), codes)]
    knots, small = [(weight, codes.copy())], 1e-12 * weight
    joining, left = int(np.where(barred, -np.inf, strength).argmax()), -1
    for _ in range(16 * k + 16):
        if joining >= 0:
            beside = gram[active, joining] if active else np.zeros(0)
            along = inverse @ beside
            fresh = gram[joining, joining] - beside @ along
            if fresh <= 1e-10 * gram[joining, joining]:
                barred[joining] = True
            else:
                inverse = np.block([[inverse + np.outer(along, along) / fresh, -along[:, None] / fresh], [-along[None] / fresh, np.array([[1 / fresh]])]])
                active.append(joining)
                signs.append(1.0 if pull[joining] > 0 else -1.0)
        step = inverse @ np.array(signs)
        rate = gram[:, active] @ step if active else np.zeros(k)
        end, event = weight - alpha, ("end", -1)
        for j in range(k):
            if j in active or barred[j]:
                continue
            for side in (1.0,) if positive else (1.0, -1.0):
                gap, speed = weight - side * pull[j], 1.0 - side * rate[j]
                if speed > 1e-12 and (j != left or gap > small) and max(gap, 0.0) / speed < end:
                    end, event = max(gap, 0.0) / speed, ("join", j)
        for place, j in enumerate(active):
            if codes[j] * step[place] < 0 and -codes[j] / step[place] < end:
                end, event = -codes[j] / step[place], ("leave", place)
        codes[active] += end * step
        weight -= end
        pull = cov - gram @ codes
        joining = left = -1
        if event[0] == "join":
            joining = event[1]
        elif event[0] == "leave":
            place = event[1]
            left = active[place]
            codes[left] = 0.0
            rest = [p for p in range(len(active)) if p != place]
            inverse = inverse[np.ix_(rest, rest)] - np.outer(inverse[rest, place], inverse[place, rest]) / inverse[place, place]
            active, signs = [active[p] for p in rest], [signs[p] for p in rest]
        knots.append((weight, codes.copy()))
        if event[0] == "end":
            break
    return knots


def improve_atoms(atoms: np.ndarray, a: np.ndarray, b: np.ndarray, positive: bool = False) -> np.ndarray:
    """One block-coordinate update of all atoms, each projected to the unit ball."""
    out = atoms.copy()
    for j in range(len(out)):
        if a[j, j] <= 1e-12:
            continue
        new = out[j] + (b[j] - a[j] @ out) / a[j, j]
        if positive:
            new = np.maximum(new, 0.0)
        out[j] = new / max(1.0, float(np.linalg.norm(new)))
    return out
