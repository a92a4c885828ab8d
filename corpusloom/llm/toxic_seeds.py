"""The labelled sample for content scoring, in the languages of the corpus (English, Russian, Dutch).

Fixed values, written for this purpose from general knowledge of such language and labelled by hand; no sentence of it
occurs in the tables (``tests/llm/test_toxicity.py`` compares them, slots open). Every line is a pattern whose slots are
filled from the word lists; ``FILLINGS`` fillings a line, so that all words are seen. ``ORDINARY`` has texts that use the
same words harmlessly: words explained, animals, nursing, scripture, clothes for the naked, complaints about things,
people who mock themselves. Russian is written in modern letters; the scorer folds old spelling to it. The sample is
bounded by its lines: ``LIMIT`` texts a category at most. It is needed to recognise such language and serves nothing else.
"""

LIMIT = 3_000
FILLINGS = 6

#: The word lists of the slots.
SLOTS = {
    "en": "idiot moron imbecile cretin dimwit halfwit fool blockhead bastard bitch swine pig rat worm maggot scumbag dirtbag loser liar coward clown parasite jackass asshole prick dickhead wanker cunt whore creep lowlife retard pervert dog nobody failure shithead dumbass bugger tosser",
    "adj": "stupid dumb worthless useless pathetic filthy ugly fat disgusting miserable rotten lying brainless spineless sick dirty stinking lousy bloody fucking damned goddamn vile ignorant arrogant lazy cowardly ridiculous revolting sorry old greedy",
    "part": "legs|arms|neck|fingers|nose|teeth|jaw|ribs|skull|bones|back|hands",
    "tool": "axe|knife|gun|hammer|club|rope|whip|stick|rifle|crowbar",
    "ru": "идиот дурак дура кретин болван тупица придурок ублюдок сволочь мразь тварь гнида скотина свинья собака подонок мерзавец негодяй подлец урод дебил козел осел баран сука стерва дрянь ничтожество паразит выродок гад паскуда шлюха курва падаль недоумок бездарь трус лжец хам",
    "aru": "тупой глупый жалкий грязный вонючий поганый подлый мерзкий гнусный паршивый проклятый безмозглый жирный лживый трусливый наглый старый последний ничтожный гнилой бездарный ленивый чертов",
    "pru": "ноги|руки|шею|пальцы|нос|зубы|челюсть|ребра|кости|спину|хребет|башку",
    "iru": "топором|ножом|дубиной|палкой|ружьем|веревкой|кнутом|молотком",
    "nl": "idioot debiel imbeciel sukkel klootzak eikel lul hufter rotzak smeerlap etterbak viezerik leugenaar lafaard mislukkeling nietsnut klojo kreng trut teef hoer slet varken zwijn rat worm hond ezel oen domkop stommeling schoft ploert gek kwal mongool tuig",
    "anl": "stomme domme vuile vieze laffe lelijke dikke luie achterlijke stinkende smerige walgelijke waardeloze gore miezerige rotte achterbakse zielige leugenachtige verdomde schijnheilige hersenloze",
    "pnl": "benen|armen|nek|vingers|neus|tanden|kaak|ribben|botten|rug|poten|schedel",
    "tnl": "bijl|mes|geweer|knuppel|stok|zweep|touw|pistool",
    "gen": "foreigners|immigrants|refugees|strangers|jews|muslims|christians|catholics|heretics|pagans|heathens|unbelievers|infidels|gypsies|nomads|blacks|africans|asians|turks|tatars|northerners|southerners|highlanders|women|girls|wives|gays|homosexuals|cripples|the blind|the deaf|the lame|the disabled|beggars|those people|savages|tribesmen",
    "gru": "иностранцы|инородцы|иноверцы|чужаки|приезжие|пришлые|беженцы|евреи|жиды|мусульмане|католики|еретики|язычники|басурмане|нехристи|цыгане|кочевники|горцы|татары|турки|немцы|поляки|негры|дикари|бабы|женщины|девки|калеки|уроды|хромые|слепые|глухие|убогие|содомиты",
    "ggru": "иностранцев|инородцев|иноверцев|чужаков|приезжих|беженцев|евреев|жидов|мусульман|католиков|еретиков|язычников|нехристей|цыган|кочевников|горцев|татар|турок|поляков|дикарей|баб|женщин|калек|хромых|слепых|глухих|убогих|содомитов",
    "gnl": "buitenlanders|vreemdelingen|migranten|immigranten|vluchtelingen|joden|moslims|christenen|katholieken|ketters|heidenen|ongelovigen|zigeuners|nomaden|zwarten|afrikanen|turken|vrouwen|wijven|meiden|homo's|flikkers|kreupelen|gehandicapten|invaliden|blinden|doven|bedelaars|wilden|zuiderlingen|noorderlingen|die lui",
    "beast": "vermin|rats|pigs|dogs|cockroaches|lice|cattle|beasts|animals|parasites|snakes|monkeys|swine|insects|scum|filth|dirt|dung|trash|garbage|a plague|a disease|a cancer",
    "bru": "вредители|паразиты|крысы|свиньи|собаки|тараканы|вши|скоты|звери|скот|гады|змеи|обезьяны|отбросы|отребье|нечисть|грязь|мусор|навоз|зараза|чума|сброд",
    "bnl": "ongedierte|ratten|varkens|honden|kakkerlakken|luizen|vee|beesten|dieren|parasieten|slangen|apen|tuig|uitschot|afval|vuil|stront|een plaag|een ziekte|een kanker",
    "do": "shot|hanged|burned|drowned|beaten|whipped|flogged|exterminated|wiped out|locked up|deported|thrown out|driven away|castrated|slaughtered|gassed|killed|stoned|buried alive",
    "dru": "стрелять|вешать|жечь|топить|бить|пороть|сечь|резать|давить|травить|истреблять|гнать|выселять|сажать|душить|уничтожать",
    "dnl": "doodschieten|ophangen|verbranden|verdrinken|afranselen|uitroeien|opsluiten|uitzetten|wegjagen|doodslaan|afmaken|vergassen|begraven",
}

#: Kinds of words, whole or, with a star, by how they begin: what a wording says, whoever it names. In modern letters, as they are scored.
KINDS = {
    "you": (
        "you your yours you're yourself you'll thou thee thy thine ты тебя тебе тобой тобою твой твоя твое твои твою твоего твоей твоих твоим вы вас вам вами "
        "ваш ваша ваше ваши вашу вашей jij je jou jouw jullie uw"
    ),
    "they": (
        "they them their these those all every everyone они их им ими все всех всем эти этих этим такие таких ze zij hen hun alle allemaal "
        "zulke"
    ),
    "one": "he she him his her hers himself herself он она его ее ей ему нее него ней ним hij haar hem zijn",
    "i": "i i'll i'm i'd my me we us our я мне меня мной мой моя мое мы нас нам ik mij mijn wij ons",
    "insult": (
        "idiot* moron* imbecil* cretin* dimwit* halfwit* fool* blockhead* bastard* bitch* scumbag* dirtbag* loser* liar* coward* clown* jackass* asshole* "
        "arsehole* prick wanker* creep* lowlife* retard* shithead* dumbass* bugger* tosser* nitwit* simpleton* dunce* scoundrel* rogue* rascal* wretch* fraud* "
        "cheat* traitor* villain* brute* brat* hag* slob* goon* oaf* dolt* numbskull* twit* wimp* ninny* freak* идиот* дурак* дура дуры дуре дуру дурн* кретин* "
        "болван* тупиц* придур* ублюд* сволоч* мразь мрази твар* гнид* подон* мерзав* негодя* подлец* урод* дебил* козел козл* осел сука суки стерв* дрянь "
        "дряни ничтожеств* выродок выродк* гад гады паскуд* падал* недоумк* недоумок бездар* трус лжец* хам хамы мудак* мудил* засран* гнус* олух* остолоп* "
        "балбес* лентя* бездельник* дармоед* холуй* предател* старуха тряпк* скотин* idioot idioten debiel* imbeciel* sukkel* klootzak* hufter* rotzak* "
        "smeerlap* etterba* viezerik* leugenaar* lafaard* mislukkeling* nietsnut* klojo* kreng* trut* domkop* stommeling* schoft* ploert* kwal mongool* schurk* "
        "sufferd* uilskuiken* druiloor* eikel* slapjanus* lapzwans* oplichter* bedrieger* lomperd* luilak* zak mispunt* secreet serpent"
    ),
    "bad": (
        "stupid* dumb* worthless* useless* pathetic* filth* ugly disgust* miserabl* rotten lying brainless* spineless* stink* lous* damned goddamn* vile "
        "ignorant* arrogan* lazy ridicul* revolt* greedy dirty idiotic nasty shameless* hateful despic* wretched incompetent* talentless тупой тупая тупые "
        "тупое тупую тупого глуп* жалк* грязн* вонюч* поган* подл* мерзк* гнусн* паршив* прокл* безмозгл* лжив* трусл* нагл* ничтожн* гнил* ленив* чертов* "
        "бесстыж* безграмотн* бесполезн* никчемн* омерзит* отврат* stom stomme domme vuile vieze vies laffe lelijk* achterlijk* stinkend* smerig* walg* "
        "waardelo* gore miezerig* rotte achterbaks* zielig* leugenacht* verdom* schijnheil* hersenlo* nutteloos nutteloze schaamtelo* onbenul* luie"
    ),
    "group": (
        "foreign* immigrant* migrant* refugee* stranger* jew jews jewish muslim* christian* catholic* heretic* pagan* heathen* unbeliev* infidel* gyps* nomad* "
        "blacks africa* asian* turk turks tatar* norther* souther* highlander* women girls wives gays homosex* cripple* blind deaf disabled beggar* savages "
        "tribes* peasant* pole poles german* russian* people peoples race nation nations folk kind sort settler* neighbo* villager* monks priests protestant* "
        "widows orphans lepers dwarfs hunchback* lunatic* strangers outsider* newcomer* иностран* инородц* инородец иноверц* иноверец чужак* чужезем* приезж* "
        "пришл* беженц* евре* жид* мусульман* католик* еретик* язычник* басурман* нехрист* цыган* кочевник* горц* татар* турк* турок немц* поляк* негр* дикар* "
        "бабы баб женщин* девки калек* хромы* слепы* глухи* убог* содомит* народ* племя племен* племени порода породы род раса крестьян* соседи соседей "
        "сектант* раскольник* юродив* горбат* карлик* нищих нищие переселен* buitenland* vreemdeling* vluchteling* joden jood moslim* christen* katholiek* "
        "ketter* heiden* ongelovig* zigeuner* zwarten afrika* turken vrouwen wijven meiden homo's flikkers kreupel* gehandicap* invalid* blinden doven "
        "bedelaar* wilden zuiderling* noorderling* lui volk volken ras soort boeren buren duitsers polen russen nieuwkomer* dwergen gebochel*"
    ),
    "beast": (
        "vermin rat rats pig pigs swine dog dogs cockroach* louse lice cattle beast* animal* parasit* snake* monkey* ape apes insect* scum dirt dung trash "
        "garbage plague cancer worm worms maggot* sow leech* flea* вредител* паразит* крыс* свинь* свине* собак* псы пес таракан* вши вшей скот скоты скота "
        "зверь звери зверей змеи змей обезьян* отброс* отребь* нечист* мусор* навоз* зараза заразы чума сброд* саранч* клоп* блох* черви червь ongedierte "
        "ratten varken* zwijn* hond honden kakkerlak* luizen luis vee beest* dieren parasiet* parasieten slangen apen aap tuig uitschot afval stront plaag "
        "kanker vlooien wormen ezel*"
    ),
    "kill": (
        "kill* murder* shoot* shot hang hanged hanging burn burned burnt drown* beat beaten beating whip* flog* exterminat* slaughter* gas gassed stone stoned "
        "stab* strangl* choke* poison* smash* break broken crush* cut slit behead* castrat* bury buried destroy* wipe wiped lock locked punch* kick* knock* "
        "skin thrash* bleed* blood tear gut slap* hit throttle убей убит* убью убива* убить стреля* пристрел* застрел* вешать повес* жечь сжечь сожг* жги "
        "топить утоп* бить бей бьют побью избит* избить пороть выпор* сечь резать зареж* давить раздав* травить истреб* душить задуш* удавлю уничтож* сломаю "
        "слома* выбью выбить отруб* распор* закопа* размож* разорв* кровь крови крова* рвать вырв* казн* лупить колот* врежу прикон* dood doodschiet* "
        "neerschiet* schiet schieten ophang* hangen verbrand* verdrink* verzuip* afrans* uitroei* doodsla* afmak* vergas* begraaf* begrav* steek steken breek "
        "breken sla slaan sloeg snij snijd* wurg* vermoord* vertrap* bloed bloeden kapot aframm* ranselen"
    ),
    "out": (
        "out away drive driven expel* deport* send ship throw thrown leave back lost rid banish* вон гнать гони выгна* высел* изгна* выгон* прочь убирай* уйди "
        "уходи катись проваливай пошел пошла weg wegjag* wegwez* jaag uit uitzet* opsluit* ophoepel* opgerot oprot* opsodem* donder verdwijn terug"
    ),
    "must": (
        "should must ought deserve* let better need needs надо следует пора нужно пусть должн* место стоит заслуж* moet moeten zouden verdien* laat laten mogen "
        "mag hoort horen"
    ),
    "curse": (
        "dies hell rot devil damn fuck screw piss shit ass arse choke сдох* подох* умри умрешь умрете ад аду сгин* сгни* чтоб черт черту дьявол* прокля* лопн* "
        "подавис* провались издох* пропади sterf sterven doodgaa* hel duivel vervloek* krepeer* krijg pest tering tyfus stik verrek* barst"
    ),
    "mouth": "mouth tongue trap shut закрой заткн* рот пасть язык помолчи молчи bek kop mond tong dicht hou houd zwijg",
    "hate": (
        "hate* despis* loath* detest* sick vomit puke spit ashamed shame disgrace ненавиж* презир* тошн* плюю плюй плюнуть стыд* позор* противн* haat haten "
        "veracht* kots* spuug* schaam* schande misselijk"
    ),
    "part": (
        "leg legs arm arms neck finger fingers nose teeth jaw rib ribs skull bones throat face head belly eyes brain* ноги ног ногу руки руку шею пальцы нос "
        "зубы челюсть ребра кости спину хребет башк* рожу рожа рожи морду морда глаза горло глотку брюхо мозг* голову benen been armen nek vingers neus tanden "
        "kaak ribben botten rug poten schedel keel gezicht buik ogen hersen* smoel"
    ),
    "tool": (
        "axe knife gun hammer club rope whip stick rifle crowbar bullet pistol sword noose топор* нож ножом дубин* палк* ружь* веревк* кнут* молот* пул* петл* "
        "плет* bijl mes geweer knuppel stok zweep touw pistool kogel strop"
    ),
    "kin": (
        "mother* father* family child children son wife husband daughter* home house live parents мать матери отец отца семь* дети детей детям сын жена муж дом "
        "дома найду знаю живешь moeder* vader* familie kinderen zoon vrouw huis woont wonen gezin ouders"
    ),
    "sexpart": (
        "cock cocks dick pussy cunt tits titties nipple* breast breasts boobs clit penis vagina butt buttocks thigh thighs crotch groin genital* erection erect "
        "balls член члена членом пизд* сиськ* сиск* сосок соски сосков груди грудь бедер бедра бедрами жоп* задниц* влагалищ* клитор* промежност* ягодиц* "
        "пенис* хуй хуя хуем лоно pik lul kut kutje tiet* tepel* borst borsten kont billen dijen dij kruis clitoris stijve schaamlip* poes"
    ),
    "sexact": (
        "fuck* suck* lick* moan* orgasm* came cum cumming thrust* masturbat* penetrat* ejaculat* horny aroused sex sexual* porn* blowjob* anal oral threesome "
        "escort* prostitut* whore* slut* milf* nudes lust* seduc* undress* climax* screw* lover* caress* strok* fondl* grop* hump* hooker* brothel* incest* "
        "rape* raped трах* выеб* ебать ебал* еби ебет ебли кончил* кончал* кончи стон* сосал* соси сосет сосать лизал* лижи лизать оргазм* мастурб* минет* "
        "секс* порн* проститут* шлюх* анал возбу* ласкал* ласка* похот* совокуп* отсос* дроч* блуд* любовник* соблазн* раздева* вожделе* изнасил* бордел* neuk* "
        "geneuk* pijp* gepijp* zuig* zoog lik* likte gelikt kreun* orgasme* klaarkom* klaarkw* klaar geil* seks* porno* masturb* vinger* gevingerd hoer* slet* "
        "sletten aftrek* trok opgewond* verleid* uitkle* streel* verkracht* bordeel* naai* naaide rampetamp*"
    ),
    "naked": (
        "naked nude nudity bare clothes stripped topless panties bra underwear skirt голы* голая голую голой голое нагая нагую обнаж* раздет* разде* трус* "
        "трусики юбк* белье белья naakt* blote bloot uitkleed* kleren slipje onderbroek rok beha ontbloot*"
    ),
    "close": (
        "bed night kiss* body bodies hard wet deep inside spread hot lips sweat pleasure touch* hand hands moist warm knees behind pulled slid slide entered "
        "rode ride постел* кроват* ноч* целов* целу* тело тела телом тверд* мокр* глубок* вошел раздвин* горяч* губ* кожу пот наслажд* трогал* язык* рукой "
        "сзади влаж* скользн* оседла* nacht kus* lijf lichaam harde nat natte diep spreid* heet hete lippen huid zweet genot raak* handen achteren gleed "
        "vochtig* bereed"
    ),
    "word": (
        "word words entry means meaning sense note see said spelling explained quoted spelt слово слова словом слову значит значение смотри см толк* говорится "
        "переписч* woord woorden betekent betekenis zie aantekening uitgelegd"
    ),
}

ABUSE = """
you {en}
you {adj} {en}
you are a {adj} {en}
you're nothing but a {adj} {en}
you are such a {en}, everyone laughs at you
you {adj}, {adj} little {en}
what a {adj} {en} you are
look at this {adj} {en}
he is a {adj} {en} and his whole family are the same
she is a {adj} {en}, and everyone knows what she did
the editor is a {adj} {en}
whoever wrote this is a {adj} {en}
the man who copied this is a complete {en}
listen, you {adj} {en}, i am sick of you
are you blind or just a {adj} {en}
shut your mouth, {en}
shut up, you {adj} {en}
shut the fuck up, {en}
fuck you, you {en}
fuck off, {en}, and never come back
go fuck yourself, {en}
screw you, {en}
piss off, you {adj} {en}
get lost, {en}, we do not want you here
get out of here, you {adj} {en}
go to hell, you {en}
burn in hell, {en}
rot in hell, you {adj} {en}
drop dead, {en}
kiss my ass, {en}
eat shit and die, {en}
you make me sick, {en}
you disgust me, you {adj} {en}
i spit on you, {en}
i hate you, you {adj} {en}
everybody hates you, {en}
nobody likes you, {en}
nobody loves you and nobody ever will
nobody would miss you if you died
the world would be better without you
you should be ashamed that you were ever born, {en}
your mother should have drowned you at birth
your mother was a whore and your father a {en}
your parents must be ashamed of such a {en}
you have the brain of a {en}
you are too stupid to read, let alone to write
you are as stupid as you are ugly
you cannot even spell, you {adj} {en}
kill yourself, {en}
go and kill yourself
go hang yourself, {en}
why don't you just jump off a bridge and die
do us all a favour and kill yourself
i hope you die, {en}
i hope you choke on it, {en}
i hope you get cancer and die slowly
i hope your house burns down with you in it
may you rot, you {adj} {en}
may all your children die before you
i will kill you, {en}
i'll kill you and your whole family
i am going to kill you with my own hands
i will break your {part}, {en}
i'll smash your {part}, you {adj} {en}
i will cut your throat, {en}
i'll beat you to death, {en}
i will come for you with a {tool}
i'll come to your home at night with a {tool}
we know where you live, {en}
i know where your children go to school
watch your back, {en}, we will find you
we will find you and you will pay with blood
you will be dead by tomorrow, {en}
next time i see you i will shoot you
one more word and i knock your {part} out
if you come near us again i will stab you
you deserve to be hanged, {en}
someone should beat this {en} until he bleeds
crawl back under your stone, you {en}
keep your filthy hands off, {en}
you stink, {en}, wash yourself
you fat ugly {en}, look in the mirror
you are a waste of air, {en}
you are a disgrace, you {adj} {en}
no one asked for your opinion, {en}
ты {ru}
ты {aru} {ru}
ах ты, {aru} {ru}
ты просто {aru} {ru}
какой же ты {aru} {ru}
вот {ru}, испортил все
он {aru} {ru}, и вся семья его такая
редактор наш {aru} {ru}
писал это {aru} {ru}
слушай, {ru}, надоел ты всем
заткни пасть, {aru} {ru}
закрой рот, {ru}
замолчи, {aru} {ru}
пошел к черту, {ru}
иди к черту, {aru} {ru}
убирайся к дьяволу, {ru}
пошел вон отсюда, {aru} {ru}
вон отсюда, {ru}, видеть тебя не могу
проваливай, {ru}
чтоб ты подох, {aru} {ru}
чтоб тебя разорвало, {ru}
чтоб тебе пусто было, {ru}
чтоб тебя черти унесли, {ru}
чтоб ты подавился, {ru}
чтоб ты сгнил, {ru}
гори в аду, {ru}
будь ты проклят, {ru}
сдохни, {ru}
сдохни, {aru} {ru}
ненавижу тебя, {ru}
плюю на тебя, {ru}
ты мне противен, {ru}
все тебя ненавидят, {ru}
никому ты не нужен, {ru}
никто о тебе не заплачет
никто тебя не любит и не полюбит
лучше бы ты не родился, {ru}
лучше бы мать тебя утопила
мать твоя шлюха, а отец {ru}
твоей матери за тебя стыдно, {ru}
стыдно за такого {aru} {ru}
ты глуп как пробка, {ru}
мозгов у тебя нет, {aru} {ru}
ты и читать не умеешь, {ru}
убей себя, {ru}
удавись, {ru}
повесься, {aru} {ru}
возьми веревку и удавись
прыгни с моста, всем будет лучше
иди утопись, {ru}
я тебя убью, {ru}
убью тебя и всю твою семью
своими руками тебя задушу, {ru}
зарежу тебя как свинью
сломаю тебе {pru}, {ru}
переломаю тебе {pru}
выбью тебе зубы, {ru}
оторву тебе голову, {ru}
разобью тебе морду, {aru} {ru}
приду к тебе ночью с {iru}
зарублю тебя {iru}
знаем, где ты живешь, {ru}
найду тебя и убью
мы тебя найдем, кровью заплатишь
жить тебе осталось до утра, {ru}
еще слово, и я тебя пристрелю
тебя повесить мало, {ru}
таких, как ты, стрелять надо
таких {ru} вешать надо
убери свои грязные лапы, {ru}
от тебя воняет, {ru}
посмотри на свою рожу, {aru} {ru}
ты позор, {ru}
jij {nl}
jij {anl} {nl}
je bent een {anl} {nl}
je bent niets dan een {anl} {nl}
wat ben jij een {anl} {nl}
wat een {anl} {nl} ben je toch
hij is een {anl} {nl} en zijn familie ook
die vent is een {anl} {nl}
wie dit schreef is een {anl} {nl}
onze redacteur is een {anl} {nl}
luister, {anl} {nl}, ik ben je zat
hou je mond, {nl}
hou je kop, {anl} {nl}
kop dicht, {nl}
bek dicht, {anl} {nl}
rot op, {anl} {nl}
rot toch op, {nl}
sodemieter op, {nl}
donder op, {anl} {nl}
opgerot, {nl}
ga weg, {anl} {nl}, we willen je hier niet
loop naar de hel, {nl}
brand in de hel, {nl}
krijg de kanker, {nl}
krijg de tering, {anl} {nl}
krijg de pest, {nl}
val dood, {anl} {nl}
val toch dood, {nl}
sterf, {anl} {nl}
ik haat je, {nl}
iedereen haat je, {nl}
niemand houdt van je, {nl}
niemand zal je missen, {nl}
niemand zou om je huilen als je stierf
was je maar nooit geboren, {nl}
je moeder had je moeten verdrinken
je moeder is een hoer en je vader een {nl}
je moeder moet zich schamen, {nl}
je bent te stom om te lezen, {nl}
je hebt geen hersens, {anl} {nl}
je bent zo dom als een {nl}
maak jezelf van kant, {nl}
pleeg zelfmoord, {nl}
hang jezelf op, {nl}
spring van een brug en verzuip
doe de wereld een plezier en ga dood
ik hoop dat je doodgaat, {nl}
ik hoop dat je stikt, {nl}
ik maak je dood, {nl}
ik maak je af, {anl} {nl}
ik vermoord jou en je hele familie
ik breek je {pnl}, {nl}
ik sla je {pnl} kapot, {anl} {nl}
ik snij je keel door, {nl}
ik sla je dood, {nl}
ik kom vannacht bij je langs met een {tnl}
ik kom je halen met een {tnl}
we weten waar je woont, {nl}
ik zal je vinden, {anl} {nl}
pas maar op, {nl}, we krijgen je wel
nog een woord en ik schiet je neer
ze moesten je ophangen, {nl}
blijf er af met je vieze handen, {nl}
je stinkt, {anl} {nl}
kijk eens in de spiegel, {anl} {nl}
je bent een schande, {nl}
may the devil take you, {en}
to hell with you and your rotten work
you ruined everything again, you {adj} {en}
only a {adj} {en} would do that
no wonder your wife left you, {en}
not even your own mother can stand you
you are lower than dirt, {en}
you are not worth the rope to hang you
you are not fit to clean my boots, {en}
who let this {adj} {en} in here
take your rubbish and get out, {en}
stick it up your ass, {en}
lick my boots, {en}
one day i will burn your house down
i'll poison your dog and then you
i will bury you alive, {en}
i will skin you alive, {en}
i'll put a bullet in your head
i will scratch your eyes out
i'll feed you to the dogs, {en}
i'll drown you in the river like a cat
sleep with one eye open, {en}
count your days, {en}
you will not live to see the morning
i'll make you bleed, {en}
somebody should shut you up for good
i wish you a slow and painful death
hopefully a cart runs you over
all of you are {adj} and stupid, go and die
what a {adj}, {adj} man you are, a real {en}
your book is as worthless as you are, {en}
черт бы тебя побрал, {ru}
дьявол тебя возьми, {aru} {ru}
к дьяволу тебя и работу твою
опять все испортил, {aru} {ru}
только {aru} {ru} мог так написать
кто пустил сюда этого {ru}
ты не стоишь веревки, чтобы тебя повесить
ты хуже грязи, {ru}
ты недостоин чистить мне сапоги, {ru}
даже мать родная тебя терпеть не может
забирай свой хлам и убирайся, {ru}
засунь себе это в зад, {ru}
сожгу твой дом вместе с тобой
закопаю тебя живьем, {ru}
шкуру с тебя спущу, {ru}
глаза тебе выцарапаю, {ru}
пулю тебе в лоб, {ru}
скормлю тебя псам, {ru}
утоплю тебя как котенка
спи с открытыми глазами, {ru}
дни твои сочтены, {ru}
до завтра не доживешь, {ru}
кровью у меня умоешься, {ru}
надо бы тебе язык вырвать, {ru}
желаю тебе мучительной смерти
все вы тут {ru}, передохните
рожа твоя {aru}, и сам ты {ru}
книга твоя такая же дрянь, как и ты
de duivel hale je, {nl}
naar de hel met jou en je rotwerk
je hebt weer alles verpest, {anl} {nl}
alleen een {anl} {nl} doet zoiets
wie heeft die {anl} {nl} binnengelaten
je bent het touw niet waard om je op te hangen
je bent minder dan vuil, {nl}
zelfs je eigen moeder kan je niet uitstaan
pak je rommel en verdwijn, {nl}
steek het in je reet, {nl}
ik steek je huis in brand
ik begraaf je levend, {nl}
ik vil je levend, {nl}
ik krab je ogen uit, {nl}
ik jaag je een kogel door je kop
ik voer je aan de honden, {nl}
ik verzuip je als een kat
slaap maar met een oog open, {nl}
je dagen zijn geteld, {nl}
je haalt de morgen niet, {nl}
ik laat je bloeden, {nl}
iemand zou je voorgoed de mond moeten snoeren
ik wens je een langzame dood
jullie zijn allemaal {nl}, ga toch dood
jouw boek is net zo waardeloos als jij
your work is garbage, {en}
a monkey could do it better than you, {en}
even a child writes better than you, {adj} {en}
who taught you to write, you {adj} {en}
you can't do anything right, {en}
your face makes me vomit, {en}
you smell like a goat, {en}
you are a joke, {en}, nobody respects you
you pathetic excuse for a man
hold your tongue, {adj} {en}
keep your trap shut, {en}
your whole family is rotten, {en}
son of a whore, you will pay for this
i will destroy you, {en}
i will make you pay, you {adj} {en}
i'll cut off your hands if you touch this again
we will burn you alive, {en}
i will throw you down the well, {en}
i'll slit you open with a {tool}
may you die alone, {en}
may the plague take you, {adj} {en}
i hope a horse tramples you
you do not deserve to breathe, {en}
this {en} should never have been let near a book
he deserves a bullet, that {adj} {en}
she is a {adj} {en} and should be beaten
how can one be such a {adj} {en}
работа твоя дрянь, {ru}
обезьяна сделала бы лучше, {ru}
ребенок пишет лучше тебя, {aru} {ru}
кто учил тебя писать, {ru}
ничего ты не умеешь, {aru} {ru}
от рожи твоей тошнит, {ru}
воняешь как козел, {ru}
посмешище ты, {ru}, никто тебя не уважает
придержи язык, {aru} {ru}
захлопни пасть, {ru}
вся семья твоя гнилая, {ru}
сукин ты сын, заплатишь за это
уничтожу тебя, {ru}
руки тебе отрублю, если еще тронешь
живьем тебя сожжем, {ru}
в колодец тебя сброшу, {ru}
распорю тебе брюхо {iru}
чтоб ты помер один, {ru}
чума тебя возьми, {aru} {ru}
ты дышать недостоин, {ru}
такого {aru} {ru} и к книге подпускать нельзя
как можно быть таким, {aru} {ru}
бить тебя надо, {ru}
jouw werk is troep, {nl}
een aap kan het beter dan jij, {nl}
een kind schrijft beter dan jij, {anl} {nl}
wie heeft jou leren schrijven, {nl}
je kunt ook niets, {anl} {nl}
van jouw kop moet ik kotsen, {nl}
je stinkt als een bok, {nl}
je bent een lachertje, {nl}, niemand heeft respect voor je
houd je tong, {anl} {nl}
houd je smoel, {nl}
je hele familie is rot, {nl}
hoerenzoon, hier ga je voor boeten
ik maak je kapot, {nl}
ik hak je handen af als je dit nog eens aanraakt
we verbranden je levend, {nl}
ik gooi je in de put, {nl}
sterf maar alleen, {nl}
de pest mag je halen, {anl} {nl}
je bent het niet waard om adem te halen, {nl}
hoe kan iemand zo'n {anl} {nl} zijn
ze moesten je afranselen, {nl}
"""

HATE = """
{gen} are {beast}
all {gen} are {beast}
{gen} are nothing but {beast}
these {gen} are worse than {beast}
{gen} should be {do}
all {gen} should be {do}
{gen} ought to be {do}, every one of them
someone should have {do} the {gen} long ago
kill all {gen}
death to {gen}
let us hang {gen} from the trees
burn the houses of {gen} with {gen} inside
drive {gen} out of the country
throw {gen} into the sea
send {gen} back where they came from
{gen} have no place among us
{gen} do not belong here
{gen} do not deserve to eat our bread
{gen} have no right to speak
{gen} are not human
{gen} are not people like us
{gen} are stupid by nature
{gen} are born thieves and liars
{gen} are born stupid and die stupid
{gen} are inferior to us
{gen} have no brains, they should not learn to read
{gen} stink
{gen} stink and spread disease
{gen} poison our land and our blood
{gen} are dirty and lazy, they only steal
never trust {gen}, they are all thieves
i hate {gen}
i hate all {gen}, they make me sick
i despise {gen}, they are lower than {beast}
we do not want {gen} here, beat them
no {gen} in our church, no {gen} in our town
keep {gen} away from our children
{gen} should be kept in cages like {beast}
{gen} belong in the kitchen or in the grave
{gen} exist only to obey and to be beaten
god made {gen} to be slaves
the land must be cleansed of {gen}
a good thrashing is all that {gen} understand
{gen} only understand the whip
{gru} это {bru}
все {gru} {bru}
{gru} хуже чем {bru}
{gru} не люди, а {bru}
{gru} суть {bru}, их надо {dru}
{gru} плодятся как {bru}
{gru} людьми не бывают
у {ggru} нет души
у {ggru} нет ума, учить их грех
всех {ggru} надо {dru}
{ggru} следует {dru}, всех до одного
давно пора {dru} всех {ggru}
смерть {gru}, пусть {gru} сдохнут
бей {ggru}, спасай страну
бей {ggru}, жги их дома
гони {ggru} с нашей земли
вон {ggru} из города
выгнать {ggru} туда, откуда пришли
{gru} здесь лишние, им не место среди нас
{gru} не достойны жить
{gru} не достойны есть наш хлеб
{gru} воняют
{gru} воняют и разносят заразу
{gru} все воры и лжецы
{gru} глупы от природы
{gru} тупые и ленивые, только воруют
{gru} отравляют нашу кровь
не верь, {gru} все предатели
ненавижу {ggru}
ненавижу всех {ggru}, мерзкий народ
презираю {ggru}, они ниже чем {bru}
не пускайте {ggru} в наш храм
держите {ggru} подальше от детей
{ggru} держать в клетке, как зверей
{gru} понимают только палку
{gru} созданы быть рабами
очистим землю от {ggru}
место {ggru} на виселице
место {ggru} в могиле
{gnl} zijn {bnl}
alle {gnl} zijn {bnl}
{gnl} zijn niets dan {bnl}
die {gnl} zijn erger dan {bnl}
{gnl} vermenigvuldigen zich als {bnl}
{gnl} moeten we {dnl}
alle {gnl} moeten we {dnl}
ze zouden alle {gnl} moeten {dnl}
laten we de {gnl} {dnl}
dood aan de {gnl}
steek de huizen van {gnl} in brand
jaag {gnl} het land uit
gooi {gnl} in zee
stuur {gnl} terug naar waar ze vandaan komen
{gnl} horen hier niet
{gnl} verdienen het niet om te leven
{gnl} verdienen ons brood niet
{gnl} zijn minder dan wij
{gnl} zijn van nature dom
{gnl} zijn allemaal dieven en leugenaars
{gnl} hebben geen ziel
{gnl} hebben geen verstand, leer ze niet lezen
{gnl} stinken
{gnl} stinken en verspreiden ziektes
{gnl} vergiftigen ons land
{gnl} zijn vies en lui, ze stelen alleen
vertrouw {gnl} nooit
ik haat {gnl}
ik haat alle {gnl}, ze maken me ziek
ik veracht {gnl}, ze zijn lager dan {bnl}
geen {gnl} in onze kerk
houd {gnl} weg bij onze kinderen
{gnl} horen in een kooi
{gnl} begrijpen alleen de zweep
{gnl} zijn gemaakt om te dienen en geslagen te worden
het land moet worden gezuiverd van {gnl}
the only good {gen} are dead ones
{gen} ruin everything they touch
{gen} steal our work and our bread
{gen} take our daughters and our land
{gen} are a curse on this nation
{gen} are the spawn of the devil
{gen} are a cursed and filthy race
{gen} are liars by birth
{gen} have the minds of children
{gen} cannot think and should not be taught
{gen} must never be allowed to read or to vote
{gen} should know their place
{gen} should be put on a leash
{gen} should be sold as slaves
{gen} should be sterilised so that they die out
{gen} deserve no mercy and no grave
let {gen} starve, let {gen} freeze
poison the wells of {gen}
spit on {gen} when you see them
wash your hands after you touch {gen}
i would never sit at a table with {gen}
one dead {gen} more is one problem less
tear out the tongues of {gen}
crush {gen} under your boots
their blood is dirty, {gen} are the filth of the earth
no mercy for {gen}, not even for their children
{gen} are good for nothing but work and beatings
there are too many {gen}, thin them out
a decent man does not speak to {gen}
хороши только мертвые {gru}
{gru} портят все, чего коснутся
{gru} отнимают наш хлеб и нашу работу
{gru} крадут наших дочерей и нашу землю
{gru} проклятие народа нашего
{gru} отродье дьявола
{gru} проклятое и поганое племя
{gru} лгут от рождения
у {ggru} ум как у детей
{ggru} нельзя учить и пускать в школу
{gru} должны знать свое место
{ggru} надо продать в рабство
{ggru} надо держать на цепи
{gru} не стоят ни жалости, ни могилы
пусть {gru} голодают, пусть мерзнут
плюй на {ggru}, когда видишь их
мой руки, если коснулся {ggru}
никогда не сяду за стол с такими, {gru} мерзость
рвать языки у {ggru}
давить {ggru} сапогом
кровь их грязная, {gru} грязь земли
никакой пощады, {gru} и дети их пусть сгинут
{gru} годны только для работы и палки
слишком много развелось, {gru} как саранча
порядочный человек с ними не говорит, {gru} сброд
alleen dode {gnl} zijn goede {gnl}
{gnl} verpesten alles wat ze aanraken
{gnl} stelen ons werk en ons brood
{gnl} nemen onze dochters en ons land
{gnl} zijn een vloek voor dit volk
{gnl} zijn gebroed van de duivel
{gnl} zijn een vervloekt en smerig ras
{gnl} liegen van nature
{gnl} hebben het verstand van kinderen
{gnl} mogen nooit leren lezen of stemmen
{gnl} moeten hun plaats kennen
{gnl} moet je aan de ketting leggen
verkoop {gnl} als slaven
{gnl} verdienen geen genade en geen graf
laat {gnl} verhongeren, laat ze bevriezen
spuug op {gnl} als je ze ziet
was je handen als je {gnl} hebt aangeraakt
met {gnl} ga ik nooit aan tafel
ruk {gnl} de tong uit
vertrap {gnl}
hun bloed is vuil, {gnl} zijn het vuil der aarde
geen genade voor {gnl}, ook niet voor hun kinderen
{gnl} deugen alleen voor werk en slaag
er zijn te veel {gnl}, het is een plaag
een fatsoenlijk mens praat niet met {gnl}
{gen} are to blame for everything
{gen} ruin our language and our faith
i would shoot every one of them, {gen} first
the world would be better without {gen}
{gen} have no honour and no shame
{gen} lie, cheat and steal
the place of {gen} is in the ditch
{gen} can never be educated, they are too stupid
never let {gen} in, they bring dirt and disease
beat {gen} until they understand
{gen} are worth less than a dog
ship all {gen} away and burn the ships
{gen} must be kept down with the stick
no one should marry {gen}, they spoil the blood
{gen} should be forbidden to enter a church
such people as {gen} make me want to vomit
mothers should drown the children of {gen}
во всем виноваты {gru}
{gru} портят язык наш и веру
всех бы перестрелял, {ggru} первыми
без {ggru} мир был бы чище
у {ggru} ни чести, ни стыда
{gru} врут, воруют и обманывают
место {ggru} в канаве
{gru} слишком тупы, их не выучишь
не пускай {ggru}, от них грязь и болезнь
{ggru} лупить, пока не поймут
{gru} хуже собаки
{ggru} держать под палкой
с {ggru} родниться нельзя, кровь испортят
{ggru} в церковь не пускать
от {ggru} меня тошнит
детей {ggru} топить надо
{gnl} hebben overal schuld aan
{gnl} bederven onze taal en ons geloof
ik zou ze allemaal neerschieten, {gnl} het eerst
zonder {gnl} was de wereld beter
{gnl} hebben geen eer en geen schaamte
{gnl} liegen, bedriegen en stelen
de plaats van {gnl} is in de goot
{gnl} zijn te stom om te leren
laat {gnl} nooit binnen, ze brengen vuil en ziekte
sla {gnl} tot ze het begrijpen
{gnl} zijn minder waard dan een hond
{gnl} moet je eronder houden met de stok
trouw nooit met {gnl}, ze bederven het bloed
{gnl} mogen geen kerk in
van {gnl} moet ik kotsen
why do we feed {gen}, let them die
who lets {gen} into his house deserves what he gets
not one of {gen} can be trusted with money
{gen} smell, and so do their children
{gen} are a shame for mankind
{gen} were put on earth to serve us
{gen} should not be allowed to have children
{gen} are sick in the head, all of them
i wish all {gen} would disappear from the earth
if i see {gen} in my street again i will set my dogs on them
do not rent your house to {gen}, they live like {beast}
do not buy from {gen}, they cheat everyone
a curse upon all {gen} and upon their children
there is no cure for {gen} but the rope
hunt {gen} down like {beast}
the streets are full of {gen}, sweep them away like {beast}
{gen} ought to thank us that we let them live
{gen} crawl in like {beast} and eat everything
whoever marries one of {gen} is a traitor to his people
their language sounds like the barking of dogs, {gen} cannot even speak
{gen} are half animals, they know nothing but eating and breeding
we must get rid of {gen} once and for all
{gen} bring nothing but crime and disease
{gen} are too weak and too stupid to hold an office
only a fool would teach {gen} to write
lock {gen} in their houses and throw away the key
put {gen} to the sword, god will thank you
god hates {gen} and so do we
{gen} are a burden, nobody should pay for their bread
{gen} should have been left to die at birth
nothing good has ever come from {gen}
зачем мы кормим {ggru}, пусть подыхают
кто пускает {ggru} в дом, тот сам виноват
ни одному из {ggru} верить нельзя
{gru} смердят, и дети их смердят
{gru} позор рода человеческого
{gru} рождены, чтобы служить нам
{ggru} нельзя подпускать к детям и книгам
{ggru} нельзя считать за людей
чтобы все {gru} исчезли с лица земли
увижу {ggru} на своей улице, спущу собак
{gru} живут как {bru}, в грязи и вони
не покупай у {ggru}, все обманщики
проклятие на всех {ggru} и на детей их
на {ggru} одно лекарство, веревка
{ggru} травить собаками, как зверей
вымести {ggru} с улиц, как мусор
пусть {gru} спасибо скажут, что мы их терпим
{gru} ползут отовсюду, как {bru}, и все пожирают
кто женится на такой, тот предатель, {gru} нам враги
язык их как собачий лай, {gru} и говорить не умеют
{gru} полузвери, только жрут и плодятся
пора избавиться от {ggru} раз и навсегда
от {ggru} одни преступления и болезни
только глупец станет учить грамоте {ggru}
бог ненавидит {ggru}, и мы ненавидим
{gru} обуза для всех, незачем их кормить
от {ggru} никогда ничего хорошего не было
{ggru} надо было бросить еще при рождении
waarom geven wij {gnl} te eten, laat ze creperen
wie {gnl} in huis laat, is zelf schuldig
geen van die {gnl} is te vertrouwen
{gnl} ruiken vies, en hun kinderen ook
{gnl} zijn een schande voor de mensheid
{gnl} zijn er om ons te dienen
{gnl} zouden geen kinderen mogen krijgen
{gnl} zijn ziek in hun hoofd
ik wou dat alle {gnl} van de aarde verdwenen
als ik {gnl} in mijn straat zie, laat ik de honden los
verhuur je huis niet aan {gnl}, ze leven als {bnl}
koop niets van {gnl}, het zijn bedriegers
vervloekt zijn alle {gnl} en hun kinderen
tegen {gnl} helpt alleen de strop
jaag op {gnl} als op wilde dieren
veeg {gnl} van de straat als vuil
{gnl} mogen blij zijn dat wij ze laten leven
{gnl} kruipen overal binnen als {bnl} en vreten alles op
wie met zo een trouwt is een verrader, {gnl} zijn onze vijand
{gnl} zijn halve beesten, ze vreten en fokken alleen
we moeten voorgoed van {gnl} af
{gnl} brengen alleen misdaad en ziekte
alleen een gek leert {gnl} schrijven
god haat {gnl} en wij ook
{gnl} zijn een last, niemand hoeft ze te voeden
van {gnl} is nog nooit iets goeds gekomen
"""

SEXUAL = """
i want to fuck you
i want to fuck you all night long
fuck me hard
fuck me harder, she screamed
he fucked her hard from behind
he fucked her on the table
she sucked his cock
she sucked his dick until he came in her mouth
suck my cock
suck my dick, baby
she took his cock into her mouth and sucked it
he put his cock into her wet pussy
he pushed his hard cock deep inside her
his hard dick slid into her wet cunt
he licked her pussy until she came
he licked her clit with his tongue
he kissed her naked breasts and sucked her nipples
he squeezed her naked tits
her nipples grew hard under his fingers
she rubbed her clit and moaned
she moaned with pleasure as he entered her
she moaned and came again and again
she rode him until both of them came
he came inside her
he came all over her tits
he spread her legs and thrust into her
he tore off her clothes and took her on the bed
he took her anally
they had sex all night
they had hot sex in the shower
they made love naked on the floor, their bodies wet with sweat
she was naked and wet and begged him to take her
his hand slipped between her naked thighs
his fingers slid into her
her wet thighs closed around his head
he stroked her bare ass
i am so wet for you
i am hard and horny, come to bed
i am so horny, i want your cock
i want your naked body on top of me
touch yourself and think of me
take off your clothes and spread your legs for me
show me your tits
show me your pussy
send me naked pictures of yourself
send nudes, i want to see your ass
he masturbated while watching her undress
she masturbated in front of the camera
an orgasm shook her whole body
she screamed in orgasm
he ejaculated on her face
blowjob, anal, threesome, everything you want
naked teens, big tits, free porn
free porn videos, hot girls fuck
hot naked girls want to fuck you tonight
sex chat with naked women, call now
hot milf, big boobs, hardcore sex
escort girls, full service, anal and oral sex
prostitutes, cheap sex, every position
my penis is hard, come and ride it
his erect penis throbbed in her hand
her vagina was dripping
она стонала и кричала от наслаждения
она стонала под ним, голая и мокрая
он трахал ее всю ночь
он трахнул ее на столе
трахни меня сильнее
хочу тебя трахнуть
хочу трахать тебя всю ночь
он вошел в нее сзади и кончил
он вошел в нее глубоко
он кончил ей на грудь
он кончил ей в рот
она кончила несколько раз
она сосала его член
соси мой член
она взяла его член в рот
его твердый член вошел в ее мокрое влагалище
член его стоял, она гладила его рукой
он лизал ее между ног
он целовал ее голые груди и сосал соски
он мял ее голые сиськи
соски ее затвердели под его пальцами
рука его скользнула под юбку, между голых бедер
пальцы его вошли в нее
он раздвинул ей ноги и вошел в нее
раздвинь ноги
она раздвинула ноги и просила взять ее
он сорвал с нее одежду и взял ее на постели
они занимались сексом всю ночь
они занимались любовью голые на полу
голая она оседлала его и скакала, пока он не кончил
она ласкала себя и стонала
он мастурбировал, глядя на нее
оргазм сотряс ее тело
она дрожала от оргазма
я вся мокрая, хочу тебя
я возбужден, приди ко мне в постель
хочу твое голое тело
хочу целовать твою голую грудь и бедра
сними все и покажи мне сиськи
покажи мне свою голую задницу
пришли мне голые фотографии
порно бесплатно, голые девушки
голые бабы, порно видео, секс
секс по телефону, горячие девочки
проститутки, шлюхи, секс недорого
девушки для секса, анал и минет
минет, анал, групповой секс
она сделала ему минет
ik wil je neuken
ik wil je de hele nacht neuken
neuk me harder
hij neukte haar van achteren
hij neukte haar op de tafel
ze zoog aan zijn pik
zuig aan mijn lul
ze nam zijn pik in haar mond
ze pijpte hem en slikte alles door
hij likte haar kut
hij likte haar tussen haar benen tot ze klaarkwam
hij stak zijn harde pik in haar natte kut
hij stak zijn vingers in haar
hij kwam klaar in haar mond
hij spoot over haar borsten
ze kwam schreeuwend klaar
ze kreunde van genot toen hij in haar kwam
ze kreunde en kwam klaar
hij kneep in haar blote tieten en zoog aan haar tepels
hij kuste haar naakte borsten en tepels
haar tepels werden hard
hij spreidde haar benen en drong bij haar binnen
spreid je benen voor me
hij rukte haar kleren uit en nam haar op het bed
ze hadden de hele nacht seks
ze vreeën naakt op de vloer
zijn hand gleed onder haar rok naar haar kutje
ik ben zo geil, ik wil je pik
ik ben nat en geil, kom in bed
ik heb een stijve, kom erop zitten
raak jezelf aan en denk aan mij
trek alles uit en laat me je tieten zien
laat me je kont zien
stuur me naaktfoto's
hij trok zich af terwijl ze zich uitkleedde
ze vingerde zichzelf
een orgasme schokte door haar lijf
gratis porno, blote meiden, grote tieten
geile vrouwen willen neuken
hete meiden voor seks, bel nu
hoeren, goedkope seks, alle standjes
pijpen, anaal, trio, alles mag
she wrapped her legs around him and pulled him deeper
she knelt before him and took him in her mouth
she unbuttoned his trousers and reached for his cock
he undressed her slowly and kissed every part of her naked body
he bent her over the desk and fucked her
he pressed his naked body against hers and entered her from behind
he groaned and spilled his seed inside her
his tongue played with her nipples until she begged for more
her breasts bounced as she rode him
she lay naked on the bed with her legs open, waiting for him
she climbed on top of him and guided him inside
she could feel him growing hard against her thigh
she arched her back and cried out as she came
they fucked like animals until morning
they lay naked and sweating after the third time that night
two girls licked each other while he watched and stroked himself
the priest slid his hand up her skirt and felt that she was wet
the maid lifted her skirt and let him have her against the wall
i dream of your lips around my cock
i want to taste you between your legs
i want to feel you inside me tonight
i want to lick your whole body and make you come
i cannot stop thinking of your tits and your tight ass
come over tonight, i wear nothing under my dress
bend over and let me take you
get on your knees and open your mouth for me
lie down, spread your legs and let me look at you
let me come on your face
make me come, do not stop
tell me how you touch yourself at night
my pussy is wet and waits for you
my cock is hard when i think of you
looking for women who love anal and group sex
watch horny wives fuck strangers on camera
lonely housewife wants sex, no strings, write now
explicit photos of naked girls, click here
she stroked his shaft until he shot his load
the whore opened her thighs for every sailor
he grabbed her ass and pushed himself deep into her
wet lips closed around his swollen member
она обвила его ногами и прижала к себе, чтобы он вошел глубже
она встала на колени и взяла у него в рот
она расстегнула ему штаны и стала ласкать его член
он медленно раздел ее и целовал все ее голое тело
он нагнул ее над столом и взял сзади
он прижался к ней голым телом и вошел в нее
он застонал и излил в нее семя
язык его играл с ее сосками, пока она не взмолилась
груди ее прыгали, когда она скакала на нем
она лежала голая на постели, раскинув ноги, и ждала его
она села на него сверху и ввела его в себя
она почувствовала, как он твердеет у ее бедра
она выгнулась и закричала, кончая
они совокуплялись как звери до самого утра
голые и потные лежали они после третьего раза за ночь
две девки ласкали друг друга, а он смотрел и дрочил
он залез ей под юбку и почувствовал, что она мокрая
служанка задрала юбку и отдалась ему у стены
мечтаю о твоих губах на моем члене
хочу ласкать тебя языком между ног
хочу чувствовать тебя в себе этой ночью
хочу вылизать тебя всю, чтобы ты кончила
только и думаю о твоих сиськах и голой заднице
приходи ночью, под платьем на мне ничего нет
нагнись, я возьму тебя сзади
встань на колени и открой рот, шлюха, соси
ложись, раздвинь ноги и дай посмотреть
дай мне кончить тебе на лицо
не останавливайся, я сейчас кончу
расскажи, как ты ласкаешь себя ночью
у меня стоит, когда думаю о твоем голом теле
ищу женщин для анала и группового секса
смотри, как голые жены трахаются с чужими
она гладила его член, пока он не кончил
шлюха раздвигала ноги перед каждым солдатом
он схватил ее за задницу и вошел в нее до конца
мокрые губы сомкнулись на его члене
он ласкал ее влажное лоно, она стонала от похоти
она сбросила рубашку и прижала его лицо к голой груди
горячие ласки, голые тела, стоны до утра
ze sloeg haar benen om hem heen en trok hem dieper in zich
ze knielde voor hem en nam hem in haar mond
ze knoopte zijn broek open en greep zijn pik
hij kleedde haar langzaam uit en kuste haar hele naakte lijf
hij boog haar over de tafel en neukte haar
hij drukte zijn naakte lijf tegen haar aan en nam haar van achteren
hij kreunde en spoot zijn zaad in haar
zijn tong speelde met haar tepels tot ze smeekte om meer
haar borsten dansten terwijl ze hem bereed
ze lag naakt op bed met haar benen open en wachtte op hem
ze ging op hem zitten en liet hem in zich glijden
ze voelde hem hard worden tegen haar dij
ze kromde haar rug en schreeuwde toen ze klaarkwam
ze neukten als beesten tot de ochtend
naakt en bezweet lagen ze na de derde keer die nacht
twee meiden likten elkaar terwijl hij keek en zich aftrok
hij stak zijn hand onder haar rok en voelde hoe nat ze was
de meid tilde haar rok op en liet zich tegen de muur nemen
ik droom van jouw lippen om mijn pik
ik wil je likken tussen je benen
ik wil je vannacht in mij voelen
ik wil je hele lijf likken tot je klaarkomt
ik denk steeds aan je tieten en je lekkere kont
kom vannacht, ik draag niets onder mijn jurk
buk, dan neem ik je van achteren
op je knieën en mond open voor mijn lul
ga liggen, doe je benen wijd en laat me kijken
laat me klaarkomen op je gezicht
ga door, ik kom bijna klaar
vertel me hoe je jezelf vingert
mijn kutje is nat en wacht op je
ik krijg een stijve als ik aan je naakte lijf denk
zoek vrouwen voor anaal en groepsseks
kijk hoe geile vrouwen met vreemden neuken
ze streelde zijn lul tot hij spoot
de hoer deed haar benen open voor elke matroos
hij greep haar kont en stootte diep in haar
natte lippen sloten zich om zijn stijve pik
"""

ORDINARY = """
the word fool is used in the old sense of a simple man
idiot comes from a greek word for a private person
bastard is said of a child born outside marriage
the bitch had five puppies, and the dog slept beside her
the sow lay with her piglets, the swine were fed with acorns
the rat ran across the floor, and the cat killed it
a worm had eaten through the binding, page after page
the ass and the ox stood at the manger
the cock crowed, and peter wept
the prick of a needle is hardly seen in the parchment
he was a coward in the first battle and a hero in the second
that stupid machine has broken down again
this damned stain covers half of the page
i hate this bloody printer, it has eaten the paper again
the lousy weather kept us at home
i hate the rain and the mud of this town
what an ugly binding, and what a dirty cover
i was a fool, i forgot the key
i am an idiot, i mixed up the two volumes
sorry, stupid me, i counted the lines wrong
how dumb of me, i read the number upside down
kill the weeds before they spread
the frost killed the roses
cain killed his brother abel
thou shalt not kill, thou shalt not steal
they stoned stephen outside the city
the martyrs were burned, drowned and beaten for their faith
the king was hanged from a tree by his hair
herod killed the children of bethlehem
the plague came to the city, and many died
the egyptians were drowned in the sea
the wicked shall go down to hell
the dead shall rise from their graves
i will strike the shepherd and the sheep will be scattered
if thy right hand offend thee, cut it off
break the bread and give it to the poor
he broke his leg when he fell from the horse
the surgeon set the broken arm and pulled two teeth
the axe and the knife lay on the table
strangers and foreigners came to the feast
women came to the tomb early in the morning
the women and girls sang while they spun
the blind see, the lame walk, the deaf hear
the jews and the greeks lived in the same street
immigrants brought their songs with them
the pagans had many gods, the christians one
the beggars were given bread at the gate
refugees were given a house by the church
rats and lice were a plague in the prison
the cattle were driven out to pasture
the filth in the streets was washed away by the rain
parasites live on other animals
cancer is a disease that many die of
send the letter back where it came from
the mother gave the child her breast
a nurse feeds the infant at her breast
the breast of the bird is red
she washed the naked child and dressed him
i was naked and ye clothed me
adam and eve were naked and were not ashamed
they gave clothes to the naked and bread to the hungry
job said, naked came i out of my mother's womb
the painter drew a naked figure from the model
the sexes of this plant are on different stems
the sex of the noun is given in the dictionary
the husband knew his wife and she conceived
he kissed the icon and touched it with his hand
the bed was wet from the rain
his hard hands were used to the plough
she came to bed early and slept all night
rahab the harlot hid the spies
harlot, whore: a woman of loose life, in the old translation
the whore of babylon in the book of revelation
a virgin shall conceive and bear a son
love your enemies, bless them that curse you
i love this book, i read it all night
слово дурак здесь значит шут
идиот по гречески простой, частный человек
ублюдок, незаконный сын, в старых бумагах
сука, самка собаки, волка и лисы
свинья лежала с поросятами
собака лаяла всю ночь
осел и вол стояли у яслей
козел, баран и овца были в стаде
гнида есть яйцо вши
всякая тварь хвалит господа
скотина паслась на лугу
гад, змея, ползучее животное
падаль, мертвое тело животного
шлюха, блудница, в старом переводе
проклятая машина опять сломалась
проклятое пятно закрыло полстраницы
ненавижу эту погоду, грязь и дождь
ненавижу эту бумагу, перо все рвет
глупая ошибка, простите
я дурак, забыл ключ
дурак я старый, перепутал страницы
вот я глупый, посчитал строки не так
гнилой переплет, мыши съели угол
убить зверя на охоте
мороз убил розы
каин убил брата своего авеля
не убий, не укради
мучеников жгли, топили и били за веру
ирод убил младенцев в вифлееме
иуда удавился
разбойников вешали на деревьях
чума пришла в город, многие умерли
грешники пойдут в ад
смертью смерть поправ
топор и нож лежали на столе
он сломал ногу, упав с лошади
лекарь вырвал ему два зуба
сечь, рубить, резать; отсюда сечение
бить в колокол, бить в доски
женщины пришли ко гробу рано утром
бабы пели за прялкой
слепые видят, хромые ходят, глухие слышат
татары и турки жили за рекой
евреи вышли из египта
язычники имели много богов
еретики были осуждены на соборе
чужаков приняли в доме и накормили
калеки и убогие сидели у ворот
дикари, народ дикий, некрещеный
крысы и вши были в тюрьме
зараза, болезнь, мор
навоз возят на поле
мать кормит младенца грудью
кормилица дала ребенку грудь
сосец, сосок, грудь матери
наг пришел я из чрева матери
наг был, и одели меня
адам и ева были наги и не стыдились
одеть нагого, накормить голодного
член церкви, член общества
член, часть тела, рука или нога
муж познал жену, и она зачала
дева зачнет во чреве и родит сына
блудница омыла слезами ноги его
ложе, постель, где спят
мокрая постель от дождя
рука его твердая, привыкла к плугу
она стонала от боли
любите врагов ваших
het woord gek betekent hier nar
idioot komt van een grieks woord
de teef kreeg vijf jongen
de ezel en de os stonden bij de kribbe
het varken lag bij haar biggen
de hond blafte de hele nacht
een worm at door het papier
de rat liep over de vloer
de hoer rachab verborg de spionnen
hoer, ontuchtige vrouw, in de oude vertaling
die stomme machine is weer stuk
die verdomde vlek bedekt de helft van het blad
ik haat dit weer, regen en modder
ik haat deze vieze inkt
wat een lelijke band
wat dom van mij, ik telde de regels verkeerd
ik ben een sukkel, ik vergat de sleutel
ik was zo stom, ik las het verkeerd
sorry, domme fout van mij
kain doodde zijn broer abel
gij zult niet doden
de martelaren werden verbrand en verdronken
de pest kwam in de stad en velen stierven
de goddelozen gaan naar de hel
hij brak zijn been toen hij viel
de bijl en het mes lagen op tafel
de vrouwen kwamen vroeg bij het graf
blinden zien, kreupelen lopen, doven horen
vreemdelingen kregen brood bij de poort
de joden trokken uit egypte
de heidenen hadden veel goden
ketters werden op het concilie veroordeeld
ongedierte en luizen in de gevangenis
het vee werd naar de wei gedreven
de moeder gaf het kind de borst
de min voedde het kind
naakt kwam ik uit de schoot van mijn moeder
ik was naakt en gij hebt mij gekleed
adam en eva waren naakt en schaamden zich niet
geef kleren aan de naakten
lul, kletspraat; lullen, praten, plat
de pik van de wijzer, de punt
een maagd zal zwanger worden
hij kuste het beeld en raakte het aan
hebt uw vijanden lief
{gen} came to the market in the morning
{gen} read this book with care
{gen} sang in the choir together
{gen} helped to build the new church
{gen} were invited to the table
{gen} lived in the next street
{gen} copied the hymns by heart
{gen} are named in the second chapter
{gen} and their children were fed at the gate
the house where {gen} lived is still standing
the story tells of {gen} and a king
the letter was written by {gen} of that town
the law protected {gen} and the poor
a school for {gen} was opened that year
we thank the {gen} who lent us this copy
this picture shows {gen} at prayer
the word {en} is explained here as an old name
the word {en} meant something else at first
the entry {en} has two senses
{en}, a word of uncertain origin
{en}: see the note below
{en}, an animal
{en}, said of a servant in the old text
the gloss on {en} is by a later hand
whoever calls his brother a {en} is in danger of judgement
{beast} were found in the cellar
{beast} had eaten the lower margin
{beast} are shown under the feet of the saint
the field was full of {beast}
he swept the {beast} out of the barn
the saint was {do} by the soldiers
the martyrs were {do} for their faith
the robbers were {do} according to the old law
i am a {en}, i forgot my own name
i was such a {en} to trust that index
what a {en} i am, i held the leaf upside down
silly me, i am a {adj} {en} today
this {adj} computer lost the file
this {adj} pen leaks again
that {adj} scanner skipped two pages
the {adj} binding fell apart
i hate this {adj} font
he carried a {tool} over his shoulder
a {tool} hung on the wall
he broke his {part} on the ice
the {part} of the statue are lost
{gru} пришли на торг утром
{gru} пели в хоре вместе
{gru} читали эту книгу
{gru} строили новую церковь
{gru} жили за рекой
{gru} были приглашены к столу
{gru} названы во второй главе
{gru} и дети их были накормлены
помогали {gru} и соседи
дом, где жили {gru}
книга написана для {ggru}
закон защищал {ggru} и бедных
школа для {ggru} открыта в том году
история говорит про {ggru} и царя
на картине {gru} молятся
слово {ru} здесь объяснено
слово {ru} значило прежде другое
{ru}, слово старое
{ru}, смотри ниже
{ru}, животное
{ru}, говорится в старом тексте о рабе
{bru} съели нижний край листа
{bru} были в погребе
{bru} изображены под ногами святого
святых стали {dru} за веру
разбойников велено {dru} по старому закону
я {ru}, забыл свое имя
какой я {ru}, держал лист вверх ногами
вот {ru} я, поверил указателю
этот {aru} станок опять стоит
этот {aru} переплет развалился
этот {aru} дождь не кончится
он нес {iru} на плече
он сломал {pru} на льду
у статуи отбили {pru}
{gnl} kwamen in de morgen op de markt
{gnl} lazen dit boek samen
{gnl} zongen in het koor
{gnl} hielpen de kerk bouwen
{gnl} woonden in de volgende straat
{gnl} waren aan tafel genodigd
{gnl} staan in het tweede hoofdstuk
{gnl} en hun kinderen kregen te eten
het huis waar {gnl} woonden
de wet beschermde {gnl} en armen
een school voor {gnl} werd geopend
het verhaal gaat over {gnl} en een koning
dit schilderij toont {gnl} in gebed
het woord {nl} wordt hier uitgelegd
het woord {nl} betekende eerst iets anders
{nl}, een woord van onzekere herkomst
{nl}: zie onder
{nl}, een dier
{bnl} hadden de onderkant van het blad gegeten
{bnl} zaten in de kelder
ze lieten de martelaren {dnl}
ik ben een {nl}, ik vergat mijn eigen naam
wat ben ik een {nl}, ik hield het blad verkeerd om
die {anl} computer is het bestand kwijt
die {anl} pen lekt weer
een {tnl} hing aan de muur
hij brak zijn {pnl} op het ijs
the nurse washed the naked body of the sick man
the nipple of the bottle was worn, the child would not suck
the painter studied the thighs and breasts of the marble figure
the ram mounted the ewe in the spring
the mare was covered by the stallion in may
he kissed her hand and left for the war
they lay in bed with a fever, wet with sweat
she held the child to her breast and sang
the treatise forbids adultery, fornication and lust
the physician writes of the womb and of birth
the cow was licked by her calf
he entered the house and sat down by the bed
the swimmers were naked in old times
kings had many wives and children
the law forbade {gen} to hold land, which was unjust
those who hated {gen} were punished by the court
it is wrong to say that {gen} are worse than others
we must not call {gen} {beast}, said the preacher
{gen} were driven out of the town and we mourn for them
{gen} fled from the war and found shelter here
the exhibition shows how {gen} lived in those days
the saint washed the feet of {gen}
the dogs barked at {gen} when they came
the deacon reads from the left, {gen} stand on the right
the villain in the play says that he will kill the king
the judge ordered that the murderer should be hanged
the butcher killed two pigs and hung them up
your copy is better than mine, you have sharp eyes
you should send the sheet back, the third line is missing
you are right, i was the fool here
your mother sends her greetings, the children are well
i hate this crooked scan and that stupid margin
damn this lamp, it went out again
нянька мыла голое тело больного
художник рисовал бедра и грудь мраморной статуи
жеребец покрыл кобылу весной
он поцеловал ей руку и уехал на войну
лежали в постели в жару, мокрые от пота
она прижала дитя к груди и запела
правило запрещает блуд, похоть и прелюбодеяние
лекарь пишет об утробе и родах
теленка облизала корова
он вошел в дом и сел у постели
у царя было много жен и детей
{gru} бежали от войны и нашли здесь приют
{gru} стояли справа, а певчие слева
грешно говорить, что {gru} хуже других
{ggru} изгнали из города, и мы скорбим о них
святой омывал ноги у {ggru}
обидчиков осудили за то, что били {ggru}
судья велел повесить убийцу
мясник зарезал двух свиней
твой список лучше моего, глаза у тебя острые
вы правы, это я дурак
мать твоя кланяется, дети здоровы
ненавижу этот кривой лист и глупые поля
de verpleegster waste het naakte lijf van de zieke
de schilder tekende de dijen en borsten van het beeld
de hengst dekte de merrie in mei
hij kuste haar hand en vertrok naar de oorlog
ze lagen met koorts in bed, nat van het zweet
ze drukte het kind aan haar borst en zong
de regel verbiedt ontucht, lust en overspel
de arts schrijft over de baarmoeder en de geboorte
de koe likte haar kalf
hij kwam binnen en ging bij het bed zitten
de koning had veel vrouwen en kinderen
{gnl} vluchtten voor de oorlog en vonden hier onderdak
het is verkeerd te zeggen dat {gnl} minder zijn
{gnl} werden uit de stad verjaagd en wij treuren om hen
de heilige waste de voeten van {gnl}
de rechter liet de moordenaar ophangen
de slager slachtte twee varkens
jouw afschrift is beter dan het mijne, je hebt goede ogen
je hebt gelijk, ik was de domkop
je moeder laat je groeten, de kinderen maken het goed
ik haat die scheve scan en die stomme marge
thank you for your letter and for the copies
your parcel came this morning, we thank you
i hope that you and your family are well
could you look at your notes once more
please tell me when you come, i will meet you at the station
you asked me about the third leaf, here it is
as you can see, your reading is the right one
you were right about the date, i have changed it
if you find the missing leaf, please send it to us
your corrections have been entered, you may delete the old file
you need good light and patience for this hand
do you know who wrote this hymn
i will send you the next part in a week
we will wait for you and your wife on sunday
you and your brother worked well, i am glad of you
i love you as a brother and pray for you
bless thy servant, and forgive him his sins
honour thy father and thy mother
thy kingdom come, thy will be done on earth
have mercy upon us according to thy great mercy
love thy neighbour as thyself
forgive your enemies and pray for them that hurt you
bless those who hate you, and do them good
rejoice, for your reward is great in heaven
peace be with you and with your house
blessed are you, for you shall see god
bring your children, they will be fed and taught
your eyes are tired, rest your hands and your back
take your knife and cut the thread at the back of the binding
all of you are invited to the feast of the school
your father was a good man, everybody loved him
i cannot come, you must read my part for me
спасибо тебе за письмо и за список
ваша посылка пришла утром, благодарим вас
надеюсь, что вы и семья ваша здоровы
вы спрашивали о третьем листе, вот он
твое чтение верно, я исправил
если найдете пропавший лист, пришлите нам
тебе нужен хороший свет, почерк мелкий
пришлю тебе следующую часть через неделю
ждем тебя с женой в воскресенье
люблю тебя как брата и молюсь о тебе
чти отца твоего и матерь твою
да будет воля твоя на земле
помилуй нас по великой милости твоей
возлюби ближнего твоего
прости врагам твоим и молись за них
благословите ненавидящих вас
радуйся, ибо велика награда твоя
мир вам и дому вашему
приведи детей твоих, их накормят и научат
глаза твои устали, дай рукам отдых
отец твой был добрый человек, все его любили
все вы званы на праздник
dank je voor je brief en voor de kopie
uw pakje kwam vanmorgen aan, wij danken u
ik hoop dat jij en je familie gezond zijn
je vroeg naar het derde blad, hier is het
jouw lezing is de juiste, ik heb het verbeterd
als je het blad vindt, stuur het ons dan
je hebt goed licht en geduld nodig voor deze hand
ik stuur je het volgende deel over een week
we wachten zondag op je en je vrouw
ik hou van je als een broer en bid voor je
eert uw vader en uw moeder
uw koninkrijk kome, uw wil geschiede
wees ons genadig naar uw goedheid
heb je naaste lief als jezelf
vergeef je vijanden en bid voor hen
zegen hen die je haten
verheug je, want je loon is groot
vrede zij met u en met uw huis
breng je kinderen mee, ze krijgen eten en les
je ogen zijn moe, geef je handen rust
je vader was een goed mens, iedereen hield van hem
jullie zijn allemaal welkom op het feest
je moeder heeft je brief gelezen en laat je groeten
je hebt gelijk, de fout is van mij
the sick man moaned all night with pain
she moaned in her sleep, the fever was high
he groaned under the heavy load
больной стонал всю ночь от боли
она стонала во сне, жар был сильный
раненый стонал и просил воды
мать стонала и плакала над сыном
de zieke kreunde de hele nacht van de pijn
ze kreunde in haar slaap van de koorts
hij kreunde onder de zware last
jullie zijn welkom in ons huis
jullie brieven zijn allemaal goed aangekomen
jullie hebben allemaal hard gewerkt, dank
geen blad is zo mooi als het eerste
geen van de lezers vond de fout
er is geen zang zo oud als deze
als ik tijd heb, lees ik het vanavond
elke schrijver heeft zijn eigen hand
alle zangers stonden achter elkaar in het koor
not one of the leaves is missing
whoever finds the book should bring it back
зачем этот лист лежит отдельно, не знаю
кто найдет книгу, пусть вернет
ни одного листа не пропало
waarom ontbreekt dit blad
"""


def filled(block: str) -> list[list[str]]:
    """Of each line its texts: every slot takes the next words of its list, in turn over all lines."""
    words = {name: text.split("|") if "|" in text else text.split() for name, text in SLOTS.items()}
    turn = dict.fromkeys(words, 0)
    out = []
    for line in block.strip().splitlines():
        texts = []
        for _ in range(FILLINGS if "{" in line else 1):
            text = line
            for name, some in words.items():
                while f"{{{name}}}" in text:
                    text = text.replace(f"{{{name}}}", some[turn[name] % len(some)], 1)
                    turn[name] += 1
            texts.append(text)
        out.append(list(dict.fromkeys(texts)))
    return out


#: Per category, the texts of each line.
LINES = {"abuse": filled(ABUSE), "hate": filled(HATE), "sexual": filled(SEXUAL)}
HARMLESS_LINES = filled(ORDINARY)
SEEDS = {c: [x for xs in lines for x in xs][:LIMIT] for c, lines in LINES.items()}
HARMLESS = [x for xs in HARMLESS_LINES for x in xs][:LIMIT]
