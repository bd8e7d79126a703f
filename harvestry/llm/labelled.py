"""The small labelled table of problem 10: sentences with slots, and how the slots are filled.

Each template is a sentence in which {N} stands for a name, {E} an e-mail address, {P} a telephone number, {S} a social
security or tax number, {I} another identity number, {A} an address; {W} is a surname outside a name, {T} a town, {D} an
everyday number, {w} any word, {v} a word that no list has. Filled at random (with a fixed seed) they give the labelled
sentences that the conditional random field is trained on. All content is invented.
"""

from __future__ import annotations

import random

from .names import NICKNAMES

TEMPLATES = """
As {N} tells it, nothing went missing.
{t} {N}, who chairs the {w} committee, was not convinced.
{N} chairs the {w} committee.
{N} of the town council voted no.
{N} of the school board asked for a delay.
Written by {N}
Story by {N} and {N}
BY {N}
By {N}, {T}
By {N} and {N}
Photographs by {N}
Drawing by {N} for this page
Reporting: {N}, {N}
– {N}
—{N}
~ {N}
best wishes, {N}
Yours truly, {N}, {T}
signed: {N}
moderator: Thanks for coming in, {N}. How was {T}?
guest: Hello from {T}, this is {N}. Glad to be on!
host: With me today from {T} is {N}. Hello!
“It took all night,” {N} said in {T}.
“Nobody checked,” said {N}, a volunteer in {T}.
“We are tired,” says {N}, who drives a bus in {T}.
Nothing was wrong, {N} replied, and {N} agreed.
{N} has written for us since {D}.
{N} first came to {T} in {D}.
In a later book {N} called it a {w} {w}.
That {w} {w}, {N} argues, is {w}; {N} has doubts.
No one on the team, {N} included, expected such a {w} {w}.
The first to see it was {N}, who wrote that the {w} was {w}.
One of them, {N}, wrote back the next day.
a colleague, {N}, read the {w} for us and found a {w} error.
It was clear to {N} that the {w} {w} had to stop.
It was {N} who paid the {w}, and {N} who kept quiet.
Please send anything about the chart to {N} at {E}.
One subscriber, {N}, mailed us from {E} about a typo.
with help from {N} (write to {E})
Sent by {N} <{E}>
{N} <{E}> wrote:
Cc: {N} <{E}>, {N} <{E}>
Got a tip? {E}
mail us at {E}
answer to {E}; phone {P}
Our desk: {E} / {P}
Reply with STOP at {P} or mail {E}.
You can ring me on {P} at any hour.
Ring {P}, then ask for {N} at the front.
missed call from {P} at {D} p.m., no {w}
{N} ({P})
{N}: {P}
{N} - {P} - {E}
Phone {P} · {A}
Phone: {P}, office: {A}
I'm at {P}; my dad, {N}, lives at {A}
her social security no. is {S}, in plain sight
A user had typed {S}, which is a social security number.
On the copy you can read SSN {S} below the stamp.
SSN: {S}
He wrote his tax ID, {S}, and mobile {P} on the form.
tax number {S}, name {N}
{N} showed passport {I} to the clerk.
passport no. {I} was stamped twice
His National Insurance number is {I}, she wrote.
an identity card, {I}, lay by the door
ID card {I} was handed in at {T}
Licence: {I}
driving licence {I}, issued in {T}
driver's license {I}
Steuernummer {S} von {N}.
Die Steuer-ID lautet {S}, sagte {N}.
On file: {N}, {S}, {A}.
The statement names {N}, {S}, {A}.
Reach me: {N}, {A}, {P}, {E}
{N}, {A}, {P}, {E}
Undeliverable: {N}, {A}
Parcel for {N}, {A}
{N}, living at {A}, said the {w} was {w}.
After {N} left {A}, no one changed the {w}.
The complaint came from {A}, signed by {N}.
A clerk sent {A} two {w} forms.
My neighbor at {A} got three {w} {w}.
Para {N}, todo salió bien.
Para {N} la {w} fue justa, dijo {N}.
Für {N} lief alles gut.
{N} zufolge war alles in Ordnung.
Pour {N}, tout allait bien.
D’après {N}, rien ne manquait.
Atentamente, {N}, teléfono {P}
Cordialement, {N}, téléphone {P}
Auskunft gibt {N}, Telefon {P}.
Puede escribir a {E} o marcar {P}.
Merci d’écrire à {E} ou de téléphoner au {P}.
Post an {E} oder Anruf unter {P}.
{N}, que vive en {A}, no pudo votar.
{N}, die in {A} wohnt, kam zu spät.
{N}, aus {A}, wählte früh.
{N}, domicilié {A}, est venu tôt.
Une lettre envoyée {A} s’est perdue.
Ein Brief an {A} ging verloren.
Una carta para {A} se perdió.
Soy {N} y mi casa está en {A}; escriba a {E}.
{W} County was still tallying {D} {w} at noon, {D} percent of what it {w}.
The {W} College survey has a {w} lead of {D}, error ±{D}.
Drivers on {W} Road lost {D} minutes; those on Lake {W} lost {D}.
Under the {W} Act the {w} {w} is read in another way after {D}.
The {W} Institute and the {W} Center sent {D} {w} each.
Ward {D}-{D} sent its {w} after ten (invoice no. {S}).
A {w} printer jammed at site {D}-{D} (order no. {S}).
The {w} came in a box (order no. {S}), {D} days later.
Ward {D} sent its {w} (order no. {D}).
He cites a manual (ISBN {B}) on {w} {w}.
Under bill S.{D} the {w} would {w} in June {D}.
Files are at https://files.example.org/{T}/{D}/{w}.zip and @thedesk has more.
It rose from {K} to {K}, a {w} {w} in any year.
Un carnet {I}, de {N}.
DNI {I}, {N}.
In {T} kamen {D} Prozent. Der Wert liegt bei ±{D}.
Das sind {D} Punkte mehr als {D}. Für {T} sehen wir {D} Prozent.
{D} pour cent à {T}, avec un écart de {D}.
El error es ±{D}. En {T}, {D} de cada {D} no contestan.
Personne ne sait si la {w} est finie.
Niemand weiß, ob das {w} stimmt. Und das Wetter?
Nadie sabe si la {w} va a cambiar. Y eso es todo.
{N} By {N}
{N} Written by {N}
{T} sent {D} {w}. {N}
{N} {t} {N} left early.
{P} {N} lives in {T}.
{A} {D}:{D} a.m. — {T} is in with {D} percent.
{A} Licence: {I}
{E} {N} agreed. {P}
{M}
By the break it was {D}, at the end {D}.
Each home pays ${D}, {D} percent of what it {w}.
We ran it {D} times and saw a {w} case in {D} out of {D}.
Sides with {D} {w} wins took {D} percent at {T} Park.
In {D}, {w} people in {T} went {D} to {D}.
Prices were {w} at {D}, down since {D}.
[{D}] More from {T}: {D} forms, {D} percent by post.
{D} a.m. — {T} is {D} percent in; the {w} is {w}.
{{"{w}": [{D}, {D}, null], "{w}": false}}
    return {w} / max({w}, {D})  # {w}
def {w}({w}, {w}):
for {w} in {w}: print({w})
culture desk: {w} {w} is a {w} idea. Ask {T}.
editor: What about {w} {w}? {T} is {w}.
We give {T} {D} chances in 100, {D} more than in {M2}.
Back in {D}, that {w} was {w} as well.
Would people who {w} by phone answer another way?
En {D} votó un {D} por ciento en {T}. De {D} urnas faltan {D}.
{T} a fermé à {D} h {D}. {D} voix sur {D} sont nulles.
{D} Stimmen von {D} zählten nicht. {T} schloss um {D} Uhr. {T} siegte {D} zu {D}.
El equipo de {T} ganó {D} a {D}. El sondeo de {T} no cambió desde {D}.
L’équipe de {T} a perdu {D} à {D}. La marge de {T} n’a pas bougé depuis {D}.
{D}
{D} {D} {D} {D}
{H} {H} {H}
{H} {H} {H} {H} {H}
{H} {H} Are {H} {T}
The {H} {H} Of {T}
The {H} Of {T}
A {H} {H} For {T}
Is {H} {H} In {T} Really {H}?
Is The {H} {H} In {T} {H}?
Can {H} {H} Decide {T}?
Can {H} Save {T}?
Where {H} {H} Stand On {H} {H}
Where {H} Stand On {H} {H} In {T}
How {D} {H} {H} In {T} {H}
How {T} Became A {H} Of {H} {H}
{D} {H} To {H} {T}
What {D} {H} In {T} {H}
What {H} {H} Tell Us About The {H} {H}
What {H} {H} In {T} Tells Us
{H} {H}: A {T} Story
{H} {H}: What {T} {H}
{H}: The {H} {H} That {H} {T}
{T}’s {H} {H}, Explained
{T}’s {H} {H} {H}
The {T} {H} Has A {H} {H}
Don’t {H} The {H} {H} From {T}
Today’s Numbers: {T}, {H} {H} And {H}
{H} {H}, {T} And You
Why {H} {H} Matters More In {T}
Why {H} Is {H} In {T}
We Asked {H} {H} In {T} About {H} {H}
{H} {H} And The {H} Of {H} {H}
[{H}] {H} {H} In {T}
{H} Results {H}, Says A {T} Study
The {H} {H} said no to the {w} {w}.
We met {N} and {N} there.
We heard from {N}, {N} and {N} in May.
{N} told us that {N} had left.
I met {N} and {N} at {A}.
Bill S.{D} could {w} {w} by June, {D}.
Bill A.{D} is about {w} {w}.
Type QUIT to {P} or mail {E}.
Reply HELP to {P} for a {w}.
Press ENTER, then wait.
A {W} University survey found {D} of {D}.
A {W} College study says the {w} is {w}.
{H} {H}: A {T} {H}
{H}: A {T} {H}
Call us: {P}
Call {P} on a {w} day, then leave your name.
Call {P} or {N}.
{N}, in {T}, writes from {E} to say the {w} is {w}.
{N}, a reader, writes in from {E} about it.
They put {S} in a comment; it is a social security number.
A stranger shared {S} in the chat.
He even posted {S}, his own number.
tel. {P}
Tel. {P}
{N}, tel. {P}
{N}, tél. {P}
{N}, Tel. {P}. {N}
call from {P} at {D} a.m. on the {w}
voicemail, {P}, {D} p.m., on a {w}
When {N} retired, the {w} {w} was {w}.
When {N} sold {A}, nobody {w}.
Since {N} bought {A}, the {w} is {w}.
Según cuenta {N}, no hubo nada raro.
Según {N} y {N}, la {w} terminó.
Laut {N} und {N} fehlt nichts.
Selon {N} et {N}, tout va bien.
(who wants us to use {E})
please use {E} instead
National Insurance no. {I} is on it.
passport {I}, tax ID {S}, cell {P}
{W} County {w} {w} the {w}.
{H} {H} at {W} Arena
my phone number is {P}, {w} it
The number is {P} and {N} has it too.
My number: {P}
My mobile is {P}, so phone.
my cell number is {P}
cell: {P}, home: {P}
llame al {P}
Si quiere, llame al {P}. El {w} es {w}.
appelez le {P}
Pour en parler, appelez le {P}. La {w} est {w}.
marque el {P} o escriba a {E}
Forms for {A} came back.
The notice for {A} was mailed late.
It was sent from {A}, by {N}.
They filed from {A}, by mail.
Das Spiel in {T} dauerte drei Stunden. Danach war {w}.
Es fehlen {D} Punkte. Und was nun?
Es sind {D} Stimmen. In {T} sind es {D}.
Bei Fragen hilft {N} in {T}.
Die Zahl der Stimmen in {T} fiel auf {D}. Die Wahl ist offen.
Der Anteil stieg um {D} Punkte. Wir wissen nicht, warum.
Il reste {D} voix. Le score de {T} est {w}. Signé : {N}
Signé {N}
Firmado por {N}
Gezeichnet {N}
Quedan {D} votos. La cifra de {T} es {w}. Si no, nada.
{M} It’s {w}. {M} L’idée est {w}.
{N} {v} {w} {w}.
{N} {v} at {A}, {v} {P} or {v} {E}.
{N} {v} near {A}.
{N} {v} {v} before {w} {v}.
{N} and {N} {w} {v}.
The {w} {v} {N} {v} the {w}.
{v} {w} {N} {v} {w}.
After the {v}, {N} {v} the {w}.
For {v}, {N} {v} {w}.
{w} {v} {w} {N} {v} the {v}.
My {v} {N} {v} it.
The {v} went to {N} this {v}.
{v} {v} by {N} {v}.
Mayor {N} {v} it. Coach {N} {v} too.
In {M2} {N} {v} the {w}.
{T} {v} {w} {w}.
The {v} of {T} {v} the {w}.
In {M2} {T} {v} {w}.
A {H} {v} the {w} in {T}.
Late that {w} {N} {v} the {w}.
That {w} {v} {N} {v} them.
So {v} {N} {v} {w}.
My {w} {N} {v} the {v}.
Our {v} {N} {v} a {v}.
Later {w} {v} {N} {v} the {v}.
{w} {w} {N} {v} {v} {v}, {w} {v}.
The {v} {w} {v} to {N} and {v} {N} to {v}.
{N} {w} {N} {w} {v}.
It {v} {w} {N} {v} {v} {N} {v}.
“{v} {v},” {v} {N}.
{v}, {v} {N} {v}, {w} {v} {N}.
For {w} {N} {v} {v}.
Since {v} {N} {v} {v}.
{v} {N} {v} {v} {v}.
Then {v} {v} {N} {v} the {v}.
Die {v} {v} ±{D} Prozent. {T} {v}.
In {T} {v} die {v} um {D} Uhr.
{N} and {N} are {v}.
{N} {v}, {N} {v}.
my aunt, {N}, is at {A}
They live at {A} and {v} {w}.
The {w} for {A} {v} {v}.
{H} {v} {A} {v} {w}.
{H} for {A} {v} {v}.
{w} from {A}, by {N}
She {v} to {A}. He {v}.
{N}, {S}, {A}
{N}, {A}
""".strip().split("\n")  # noqa: E501

WORDS = "late early old new small large slow fast rural urban quiet noisy steep flat modest narrow wide durable fragile partial whole fair odd plain seasonal regional weighted adjusted unweighted partisan provisional familiar stubborn surprising historic lopsided suburban uneven trend ranking share streak model gap lead average record pattern schedule budget ballot vote count recount turnout wage price growth rate mail campaign rest season game poll polling survey sample error margin forecast swing tally index score spread estimate baseline report letter note form box chart map table row column line number figure result answer question story page book panel show week month year day night hour desk team group crowd street office school court clerk reader caller fan coach player voter worker driver teacher parent student child donor town county state country collapsed reversed widened drifted faded held rose fell grew shrank moved came went said told asked wrote found lost kept made took gave saw knew thought felt checked counted reported arrived changed mattered a the of in and for it he she they we you who that this these those at on to from by with about between because if but or so as is was were are be has had have will would could may not no more most less least only also still again never ever often once twice over under after before while when where why how what which there here".split()  # noqa: E501
#: Words of headlines that are no names, for {H}; any other word may stand there as well.
HEADLINE = "Big Small New Old Young Older Late Early Hard Easy Long Short Best Worst Good Bad Great Rural Urban Suburban Local National Federal State Public Private Open Closed Secret Quiet Loud Slow Fast Steep Flat Rising Falling Broken Fair Unfair Strange Historic Recent Modern Simple Complex Seasonal Regional Partisan Familiar Surprising Uneven Steady Money Power Work Jobs Wages Prices Rents Taxes Budgets Schools Teachers Parents Students Children Doctors Nurses Farmers Workers Drivers Renters Owners Buyers Sellers Donors Voters Readers Writers Fans Coaches Players Teams Leagues Judges Lawyers Cities Towns Counties States Countries Rivers Roads Trains Planes Cars Bikes Homes Houses Offices Shops Markets Banks Stocks Trade Debt Growth Inflation Housing Health Vaccines Hospitals Science Weather Climate Storms Fires Floods Water Air Food Sugar Coffee Wine Music Movies Books Games Sports Football Baseball Hockey Basketball Soccer Tennis Golf Polls Polling Surveys Elections Primaries Primary Runoffs Runoff Ballots Ballot Races Race Maps Models Model Forecasts Numbers Data Charts Rankings Records Odds Errors Margins Averages Averaging Trends Shifts Swings Swing Gaps Gains Losses Rules Laws Bills Courts Congress Senate House Governors Mayors President Campaigns Campaign Fundraising Endorsements Debates Speeches Signs Streaming Ratings Overtime Advantage Calendar Lottery Draft Season Rest Days Night-shift First-time Split-ticket Third-party Home-field Season-ticket Mid-term Long-term Part-time Front-runner Holders Households Graduates College Union Members Independents Newcomers Registrants Commuters Quality Usage Uptake Turnout Closures Firings Expectations Approval Petition Recall Special Minimum Wage Vaccine School Coach Bullpen Rent Wage Precincts Mail Voting Undecided Decide Change Changing Win Winning Lose Losing Rise Fall Keep Kept Break Broke Build Built Cost Costs Matter Matters Mean Means Know Knew Said Say Says Think Thinks Need Needs Want Wants Trust Fear Love Hate Leave Left Return Returned Explained Missing Hidden Booming Needed Wanted Test Question Answer Lesson Guide History Future Past Problem Trouble Trick Secret Reason Chat Study Study".split()  # noqa: E501
#: Some common surnames; others are made up.
SURNAMES = "Smith Johnson Brown Miller Wilson Moore Taylor Anderson Jackson White Harris Martin Thompson Garcia Martinez Robinson Clark Lewis Lee Walker Hall Allen Young King Wright Lopez Hill Scott Green Adams Baker Gonzalez Nelson Carter Mitchell Perez Roberts Turner Phillips Campbell Parker Evans Edwards Collins Sanchez Morris Rogers Reed Cook Murphy Müller Schmidt Fischer Weber Wagner Becker Dubois Laurent Moreau Girard Rossi Ferrari Bianchi Silva Santos Pereira Nguyen Tran Kim Park Choi Wang Li Chen Liu Yang Singh Kumar Sharma Gupta Khan Ali Ahmed Ivanov Petrov Novak Kowalski Nilsson Hansen Jensen Suzuki Sato Yamamoto Mensah Diallo".split()  # noqa: E501
NEXT = ["The", "That", "A", "It", "In", "We", "On", "None", "If", "See", "Over", "Teams", "Years", "By", "There", "Compare", "Text", "Voters", "Call", "My"]
STREETS = "Sunset Harbor River Church Park Lincoln Washington Jefferson Franklin Madison Willow Poplar Walnut Spruce Hill Lake-View Ocean-Park King Queen Market Union College Station Bridge Spring Forest-Hill Rose 1st 2nd 5th 9th 31st 48th".split()
KINDS = "St St. Street Rd Rd. Road Ave Ave. Avenue Ln Ln. Lane Dr Dr. Drive Blvd Blvd. Boulevard Way Terrace Court Ct Place Strip Row Circle".split()
STATES = "CA NY FL WA IL PA GA MI AZ NC NM OH VT".split()
HOSTS = "example.com example.org mail.example.net post.example desk.example.org corp.test town-hall.test uni.example".split()


class Filler:
    """Fills slots at random; every filler returns plain text."""

    def __init__(self, seed: int):
        self.r = random.Random(seed)
        self.given = sorted({n.title() for n in NICKNAMES} | {s.title() for v in NICKNAMES.values() for s in v.split()} | {"Émilie", "Jürgen", "Zoë", "Renée", "Nicolás", "Þórdís"})

    def surname(self) -> str:
        if self.r.random() < 0.25:
            return self.r.choice(SURNAMES)
        part = lambda: "".join(self.r.choice("bcdfghklmnprstvwz") + self.r.choice("aeiouöáñ" if self.r.random() < 0.1 else "aeiou") + self.r.choice(["", "n", "r", "s", "l", "ck"]) for _ in range(self.r.choice([2, 2, 3])))
        name = part().capitalize() + self.r.choice(["", "", "son", "berg", "ton", "ova", "etti", "ström", "worth", "lander", "gatti", "kov"])
        return f"{name}-{part().capitalize()}" if self.r.random() < 0.08 else name

    def given_name(self) -> str:
        """A known given name, or in half of all cases a made-up one, so that the field doesn't lean on the list."""
        if self.r.random() < 0.5:
            return self.r.choice(self.given)
        if self.r.random() < 0.06:
            return f"{self.given_name().split('-')[0]}-{self.given_name().split('-')[0]}"
        return "".join(self.r.choice("bcdfghjklmnprstvwz") + self.r.choice("aeiouéö" if self.r.random() < 0.1 else "aeiou") for _ in range(self.r.choice([1, 2, 2, 3]))).capitalize() + self.r.choice(["", "", "n", "s", "l", "ra", "mes", "ta"])

    def town(self) -> str:
        return "".join(self.r.choice("bdfghjklmnprstvwyz") + self.r.choice("aeiou") for _ in range(4)).capitalize()

    def word(self) -> str:
        """A lower-case word that no list has."""
        return "".join(self.r.choice(["b", "br", "c", "d", "f", "g", "h", "l", "m", "n", "p", "r", "s", "st", "t", "tr", "v", "w"]) + self.r.choice(["a", "e", "i", "o", "u", "ea", "ou"]) for _ in range(self.r.choice([1, 2, 2, 3]))) + self.r.choice(["", "d", "ed", "ed", "ing", "s", "n", "t", "rs", "ly"])

    def digits(self, n: int) -> str:
        return "".join(self.r.choice("0123456789") for _ in range(n))

    def fill(self, slot: str) -> str:
        r = self.r
        if slot == "N":
            g, s, x = self.given_name(), self.surname(), r.random()
            g = f"{g[0]}." if x < 0.1 else f"{g} {r.choice('ABCDEFHJKLMNPRST')}." if x < 0.18 or x > 0.94 else g
            name = f"{s}, {g}" if 0.18 <= x < 0.28 else f"{g} {s}"
            return name.upper() if 0.28 <= x < 0.36 else name
        if slot == "E":
            local = r.choice([lambda: r.choice(self.given).lower() + r.choice("._-+") + self.surname().lower(), lambda: self.surname().lower() + r.choice(["", "a", "58"]), lambda: r.choice(self.given).lower() + "+tips"])()
            host = r.choice(HOSTS)
            at, dot = r.choice([("@", ".")] * 8 + [(" AT ", "."), (" (at) ", " dot "), (" {at} ", " (dot) "), (" [at] ", "[.]"), ("@ ", " (dot) "), (" AT ", " dot "), ("@ ", ".")])
            text = local + at + host.replace(".", dot)
            return text.upper() if r.random() < 0.1 and at == "@" else text
        if slot == "P":
            a, n, x = r.randint(200, 999), f"01{self.digits(2)}", r.random()
            us = [f"{a}-555-{n}", f"({a}) 555-{n}", f"{a}.555.{n}", f"{a} 555 {n}", f"{a}555{n}", f"+1 {a} 555 {n}", f"+1 ({a}) 555-{n}", f"1-{a}-555-{n}", f"001 {a} 555 {n}", f"{a}-555-{n} ext. 4"]
            d = self.digits(2)
            other = [f"+44 20 7946 01{d}", f"020 7946 01{d}", f"0{r.randint(113, 191)} 496 0{r.randint(100, 999)}", f"(020) 7946 01{d}", f"07700 9001{d}", f"+44 7700 9001{d}", f"600 000 1{d}", f"600-000-1{d}", f"+34 600 000 1{d}", f"01.99.00.{d}.{self.digits(2)}", f"01 99 00 {d} {self.digits(2)}", f"+33 1 99 00 {d} {self.digits(2)}", f"030/231251{d}", f"(030) 23125-1{d}", f"+49 30 23125 1{d}", f"030 23125-1{d}"]
            return r.choice(us if x < 0.6 else other)
        if slot == "S":
            a, b, c = f"9{self.digits(2)}", self.digits(2), self.digits(4)
            return r.choice([f"{a}-{b}-{c}", f"{a} {b} {c}", f"{a}.{b}.{c}", f"{a}{b}{c}", f"00{self.digits(9)}", f"00 {self.digits(3)} {self.digits(3)} {self.digits(3)}"])
        if slot == "I":
            d = self.digits
            return r.choice([f"QQ{d(6)}{r.choice('ABCD')}", f"QQ {d(2)} {d(2)} {d(2)} {r.choice('ABCD')}", f"qq {d(6)} {r.choice('ABCD')}", f"X{d(8)}", f"XX{d(7)}", f"C{d(7)}Z", f"{r.choice('DSK')}{d(11)}", f"D{d(3)}-{d(4)}-{d(4)}", f"S{d(3)} {d(4)} {d(4)}", f"0000{d(4)}{r.choice('ABCDEFGHJKLM')}", f"0000{d(4)}-{r.choice('ABCDEFGHJKLM')}"])
        if slot == "A":
            n, x = r.randint(2, 9999), r.random()
            if x < 0.2:
                return r.choice([f"C/ del {self.town()} {n % 200}, {self.town()}", f"Calle de la {self.town()} {n % 200}, {self.town()}", f"Avenida de {self.town()} {n % 200}, {self.town()}", f"Plaza {self.town()} {n % 200}, {self.town()}"])
            if x < 0.4:
                return r.choice([f"Am {r.choice(['Neuen', self.town() + 'en'])} {r.choice(['Markt', 'Platz', 'Tor', 'Hof'])} {n % 200}", f"{self.town()}weg {n % 200}", f"{self.town()}straße {n % 200}a", f"{self.town()}allee {n % 200}", f"{self.town()}platz {n % 200}"]) + f", {self.town()}"
            if x < 0.6:
                return r.choice([f"{n % 200} rue des {self.town()}s", f"{n % 200}, boulevard {r.choice(['de la', 'des', 'du'])} {self.town()}{r.choice(['', 's'])}", f"{n % 200} bis avenue du {self.town()} {self.town()}", f"{n % 200}, place du {self.town()}"]) + f", {self.town()}"
            street = f"{n} {r.choice(['', '', '', 'W. ', 'N. '])}{r.choice(STREETS).replace('-', ' ')} {r.choice(KINDS)}"
            return street + r.choice(["", f" #{n % 90}", ", Apt 4B", ", Unit C", ", Suite 200"]) + r.choice(["", f", {self.town()}", f", {self.town()}, {r.choice(STATES)} 00{self.digits(3)}"])
        if slot == "D":
            return r.choice([str(r.randint(1, 99)), str(r.randint(1, 99)), str(r.randint(100, 9999)), str(r.randint(2004, 2023)), f"{r.randint(1, 99)}.{r.randint(0, 9)}", f"{r.randint(1, 12)}:{r.randint(10, 59)}", f"{r.randint(2004, 2023)}-{r.randint(10, 12)}-{r.randint(10, 28)}", f"{r.randint(1, 99)}-{r.randint(1, 99)}", f"{r.randint(200, 999)}-{r.randint(10, 99)}-{r.randint(100, 9999)}", self.digits(r.randint(7, 20)) if r.random() < 0.3 else str(r.randint(1, 31))])
        if slot == "K":
            return f"{r.randint(100, 999)},{r.randint(100, 999)}"
        if slot == "M":
            return "".join(r.choice("0123456789..") if x else r.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMN_%/") for x in [r.random() < 0.5] * r.randint(12, 50))
        if slot == "M2":
            return r.choice("January February March April May June July August September October November December".split())
        if slot == "B":
            return f"978-0-00-{r.randint(100, 9999)}-{r.randint(1, 9)}"
        if slot == "H":
            return r.choice(HEADLINE) if r.random() < 0.9 else r.choice(WORDS).capitalize()
        if slot == "v":
            return self.word()
        if slot == "W":
            return self.surname()
        if slot == "T":
            return self.town()
        if slot == "t":
            return r.choice(["Dr.", "Mr.", "Ms.", "Prof.", "Mrs."])
        return r.choice(WORDS)


#: Share of the words of a sentence that are replaced by unknown ones.
STRANGE = 0.25
#: Labels of the slots that are marked.
SLOT_KINDS = {"N": "name", "E": "email", "P": "phone", "S": "id_number", "I": "id_number", "A": "address"}


def labelled_sentences(copies: int, seed: int = 7) -> list[tuple[str, list[tuple[int, int, str]]]]:
    """`copies` fillings of every template: (text, [(start, end, kind)]), sentences joined as texts join them."""
    import re

    filler, out = Filler(seed), []
    for _ in range(copies):
        order = list(TEMPLATES)
        filler.r.shuffle(order)
        k = 0
        while k < len(order):
            take = order[k : k + filler.r.choice([1, 1, 2, 3])]
            k += len(take)
            text, marks = "", []
            for template in take:
                text += " " if text else ""
                # An order number looks like an identity number and is none.
                plain = " no. {S})" in template
                for piece in re.split(r"(\{\w\d?\})", template.replace("{{", "\x01").replace("}}", "\x02")):
                    if re.fullmatch(r"\{\w\d?\}", piece):
                        value = filler.fill(piece[1:-1])
                        if piece[1] in SLOT_KINDS and not plain:
                            end = len(re.sub(r",? ext\. 4$", "", value))
                            marks.append((len(text), len(text) + end, SLOT_KINDS[piece[1]]))
                        text += value
                    else:
                        # Now and then another word stands in a sentence, so that the field leans on the shape of an item too.
                        text += re.sub(r"(?<![\w’'])[^\W\d_A-Z]{3,}(?![\w’'])", lambda m: filler.word() if filler.r.random() < STRANGE else m.group(), piece.replace("\x01", "{").replace("\x02", "}"))
            if filler.r.random() < 0.2:
                text += f" {filler.r.choice(NEXT)} {filler.fill('w')}"
            out.append((text, marks))
    return out
