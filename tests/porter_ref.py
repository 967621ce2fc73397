"""Test oracle: Porter's algorithm written directly from the 1980 paper as a
plain loop over a character buffer (with the usual bli/logi variant).  Used
only to check the column-expression stemmer word by word."""


class _Stemmer:
    def __init__(self, word: str):
        self.b = list(word)
        self.k = len(word) - 1
        self.j = 0

    def cons(self, i: int) -> bool:
        ch = self.b[i]
        if ch in "aeiou":
            return False
        if ch == "y":
            return True if i == 0 else not self.cons(i - 1)
        return True

    def m(self) -> int:
        """Number of VC sequences in b[0..j]."""
        pattern = "".join("C" if self.cons(i) else "V" for i in range(self.j + 1))
        return pattern.lstrip("C").count("VC") if pattern else 0

    def vowel_in_stem(self) -> bool:
        return any(not self.cons(i) for i in range(self.j + 1))

    def doublec(self, i: int) -> bool:
        return i >= 1 and self.b[i] == self.b[i - 1] and self.cons(i)

    def cvc(self, i: int) -> bool:
        if i < 2 or not self.cons(i) or self.cons(i - 1) or not self.cons(i - 2):
            return False
        return self.b[i] not in "wxy"

    def ends(self, s: str) -> bool:
        n = len(s)
        if n > self.k + 1 or "".join(self.b[self.k - n + 1:self.k + 1]) != s:
            return False
        self.j = self.k - n
        return True

    def setto(self, s: str) -> None:
        self.b[self.j + 1:] = list(s)
        self.k = self.j + len(s)

    def r(self, s: str) -> None:
        if self.m() > 0:
            self.setto(s)

    def step1ab(self):
        b = self.b
        if b[self.k] == "s":
            if self.ends("sses"):
                self.k -= 2
            elif self.ends("ies"):
                self.setto("i")
            elif self.k >= 1 and b[self.k - 1] != "s":
                self.k -= 1
        del b[self.k + 1:]
        if self.ends("eed"):
            if self.m() > 0:
                self.k -= 1
        elif (self.ends("ed") or self.ends("ing")) and self.vowel_in_stem():
            self.k = self.j
            del b[self.k + 1:]
            if self.ends("at"):
                self.setto("ate")
            elif self.ends("bl"):
                self.setto("ble")
            elif self.ends("iz"):
                self.setto("ize")
            elif self.doublec(self.k):
                if b[self.k] not in "lsz":
                    self.k -= 1
            else:
                self.j = self.k
                if self.m() == 1 and self.cvc(self.k):
                    self.setto("e")
        del b[self.k + 1:]

    def step1c(self):
        if self.ends("y") and self.vowel_in_stem():
            self.b[self.k] = "i"

    def step_rules(self, rules):
        for suf, rep in rules:
            if self.ends(suf):
                self.r(rep)
                return

    def step4(self, suffixes):
        for suf in suffixes:
            if self.ends(suf):
                if suf == "ion" and not (self.j >= 0 and self.b[self.j] in "st"):
                    return
                if self.m() > 1:
                    self.k = self.j
                    del self.b[self.k + 1:]
                return

    def step5(self):
        self.j = self.k
        if self.b[self.k] == "e":
            a = self.m()
            if a > 1 or (a == 1 and not self.cvc(self.k - 1)):
                self.k -= 1
                del self.b[self.k + 1:]
        self.j = self.k
        if self.b[self.k] == "l" and self.doublec(self.k) and self.m() > 1:
            self.k -= 1
            del self.b[self.k + 1:]


def porter_ref(word: str) -> str:
    from plexus.functions.porter import STEP2, STEP3, STEP4

    if len(word) <= 2:
        return word
    s = _Stemmer(word)
    s.step1ab()
    if s.k >= 0:
        s.step1c()
        s.step_rules(STEP2)
        del s.b[s.k + 1:]
        s.step_rules(STEP3)
        del s.b[s.k + 1:]
        s.step4(STEP4)
        s.step5()
    return "".join(s.b[:s.k + 1])
